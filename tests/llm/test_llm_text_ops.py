"""URL rules, decontamination, personal data, repeated lines, packing and shards against brute force."""

import hashlib
import random
import re
import sys
import zlib
from itertools import combinations
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from llm_helpers import ODD_IDS, ODD_TEXTS, clashing, docs_frame, rows_of, words  # noqa: E402

from ledgerlake.llm import decontaminate, lines, packing, pii, shards  # noqa: E402
from ledgerlake.llm.common import pick  # noqa: E402
from ledgerlake.llm.url_rules import RuleTrie, judge_urls, split_url  # noqa: E402

RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]


# ---------------------------------------------------------------- URL rules
def test_split_url():
    assert split_url("http://A.Example.com/En/1?x#y") == ("a.example.com", "/En/1")
    assert split_url("x://h?q") == ("h", "") and split_url("x://h#f/a") == ("h", "")
    assert split_url("no-scheme.com/a") == ("", "") and split_url(None) == ("", "") and split_url("://") == ("", "")
    assert split_url("É://É.COM/a://b") == ("É.com", "/a://b")


def test_trie_agrees_with_brute_force():
    rng = random.Random(5)
    hosts = ["com", "a.com", "b.a.com", "net", "x.net", "acom", "a.b.net"]
    paths = ["", "/", "/e", "/en", "/en/", "/en/a", "/en/ab/", "/x"]
    for _ in range(30):
        rules = [(rng.choice(["allow", "block"]), rng.choice(hosts), rng.choice(paths)) for _ in range(6)]
        trie = RuleTrie(rules)
        for host in hosts:
            for path in paths + ["/en/abc", "/en/ab/c", "/english"]:
                fits = [(len(h.split(".")), len(p), a == "block", (a, h + p)) for a, h, p in rules
                        if (host == h or host.endswith("." + h)) and path.startswith(p)]
                assert trie.find(host, path) == (max(fits)[3] if fits else None)


def test_urls_odd_rows(spark):
    pages = spark.createDataFrame([(1, None), (1, None), (2, ""), (3, "http://q.net/es/1"), (None, "http://www.example.com/en/")],
                                  "page_id long, url string")
    pages = pages.selectExpr("*", "'x' AS host", "'y' AS verdict", "1 AS id")
    got = rows_of(judge_urls(pages, RULES))
    assert got == sorted([(1, "", "", None, "allow")] * 2 + [(2, "", "", None, "allow"), (3, "q.net", "/es/1", "net/es/", "block"),
                          (None, "www.example.com", "/en/", "www.example.com/en/", "allow")], key=repr)
    assert judge_urls(pages.limit(0), RULES).count() == 0
    with pytest.raises(ValueError):
        judge_urls(pages, [("maybe", "com", "/")])


# ---------------------------------------------------------------- decontamination
def brute_hits(text, items, window=10):
    low = lambda t: re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    split = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low(t))
    w, hit, found = split(text), set(), set()
    for item, t in items:
        v = split(t)
        n = min(window, len(v))
        for i in range(len(v) - n + 1 if n else 0):
            for j in range(len(w) - n + 1):
                if w[j:j + n] == v[i:i + n]:
                    hit |= set(range(j, j + n))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("max_chars", [decontaminate.MAX_CHARS, 60])
def test_hits_agree_with_brute_force(spark, max_chars):
    rng = random.Random(3)
    items = [(i, words(rng, n, 30)) for i, n in enumerate([3, 10, 14, 25, 0, 12])] + [(9, None), (10, "  ,. "), (11, "W3, É!"), (3, "w1")]
    texts = [words(rng, 60, 30) + " " + rng.choice(items)[1 if k % 3 else 1].__str__().upper() + ". " + words(rng, 9, 30) for k in range(40)]
    texts += [None, "", "w3-É", "É w3 é", "w3 É"] + ["w1 " * 500]
    docs = docs_frame(spark, texts)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.find_hits(clashing(docs), bench, max_chars=max_chars).collect()}
    for i, t in enumerate(texts):
        assert (got[i]["n_words"], got[i]["n_hit"], sorted(got[i]["items"])) == brute_hits(t, items), t
        inside = "".join((t or "")[s["start"]:s["end"]] + " " for s in got[i]["spans"])
        assert len(re.findall("[0-9A-Za-z\x80-\U0010ffff]+", inside)) == got[i]["n_hit"]
    left = {r["doc_id"] for r in decontaminate.drop_contaminated(docs, bench, max_chars=max_chars).collect()}
    assert left == {i for i, r in got.items() if r["n_hit"] == 0}


def test_hits_odd_tables(spark):
    docs = docs_frame(spark, ODD_TEXTS, ODD_IDS)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_hits(docs, none).where("n_hit > 0").count() == 0
    assert rows_of(decontaminate.drop_contaminated(docs, none)) == rows_of(docs)
    assert decontaminate.find_hits(docs.limit(0), none).count() == 0


# ---------------------------------------------------------------- personal data
_PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
          "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    out = []
    for kind, p in _PLAIN.items():
        for m in re.finditer(p, text):
            d = [int(c) for c in re.sub("[^0-9]", "", m.group())]
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else False,
                  "card": 13 <= len(d) <= 19 and sum(sum(divmod(x * (1 + i % 2), 10)) for i, x in enumerate(reversed(d))) % 10 == 0,
                  "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, *m.span()))
    return out


def test_base_spans_agree_with_plain_patterns():
    rng = random.Random(11)
    pieces = ["a@b.co", "x.y%z@m-1.example.com", "@", ".", "_", "+1 (212) 555-0153", "+", "1", "25.86.162.211", "999.1.1.1", "0001.2.3.4",
              "4111 1111 1111 1111", "4111-1111-1111-1111", "4111 1111 1111 1112", "5", "é", " ", "-", "\n", "١٢", "a", "12345678901234567890"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(12)))
        assert [s[:3] for s in pii.base_spans(text.encode())] == brute_spans(text), text
    assert pii.base_spans(("1" * 200_000).encode()) == [] and pii.base_spans(("a" * 200_000 + "@").encode()) == []


def test_terms_that_reveal_an_entity(spark):
    rng = random.Random(2)
    filler = lambda: " ".join(rng.choice(["oak", "elm", "ash", "fir", "yew"]) for _ in range(12))
    texts = [f"{filler()} agent Zorrak bob@corp.example.com {filler()} {i}" for i in range(6)]
    texts += [f"{filler()} zorrak {filler()}"] + [filler() + f" agent {i}" for i in range(200)] + [None, "", texts[0]]
    docs = clashing(docs_frame(spark, texts))
    for max_terms in (pii.MAX_TERMS, 2):
        risky = {r["term"]: r for r in pii.risky_terms(docs, max_terms=max_terms).collect()}
        assert set(risky) == {"zorrak"}
        got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in pii.find_personal_data(docs, max_terms=max_terms).collect()}
        at = texts[6].index("zorrak")
        assert [s[1:] for s in got[6]] == [(at, at + 6)] and got[7] == [] and got[207] == []
        assert got[0][0][0] == "email" and got[0][1][0] in pii.TERM_KINDS
    clean = {r["doc_id"]: r["text"] for r in pick(pii.sanitise(docs), doc_id="doc_id", text="text").collect()}
    assert "zorrak" not in clean[0].lower() and "@" not in clean[0] and "[EMAIL]" in clean[0]
    assert clean[7] == texts[7] and clean[207] is None and clean[208] == ""
    assert pii.sanitise(docs).columns == docs.columns


def test_copies_hide_no_revealing_term(spark):
    texts = [f"oak elm Zorrak bob@corp.example.com fir {'ash ' * i}" for i in range(3)] * 10 + [f"oak elm fir ash {i}" for i in range(3000)]
    risky = {r["term"]: (r["kind"], r["disclosure"]) for r in pii.risky_terms(docs_frame(spark, texts)).collect()}
    once = {r["term"]: (r["kind"], r["disclosure"]) for r in pii.risky_terms(docs_frame(spark, sorted(set(texts)))).collect()}
    assert set(risky) == {"zorrak"} and risky == once


def test_terms_beside_an_only_email_and_beside_a_domain(spark):
    filler = lambda i: f"oak elm fir ash yew {'oak ' * (i % 7)}"
    texts = [f"{filler(i)} {i}" for i in range(4000)] + ["oak elm Quimby q1@one.example fir ash"]
    texts += [f"oak elm Vexcorp person{i}@vex.example fir ash {i}" for i in range(5)]
    risky = {r["term"]: r["kind"] for r in pii.risky_terms(docs_frame(spark, texts)).collect()}
    assert set(risky) == {"quimby", "vexcorp"} and set(risky.values()) <= set(pii.TERM_KINDS)


def test_personal_data_odd_rows(spark):
    docs = docs_frame(spark, ODD_TEXTS, ODD_IDS)
    assert [r["spans"] for r in pii.find_personal_data(docs).collect()] == [[]] * len(ODD_TEXTS)
    assert rows_of(pii.sanitise(docs)) == rows_of(docs)
    assert pii.find_personal_data(docs.limit(0)).count() == 0


# ---------------------------------------------------------------- repeated lines
def test_repeated_lines_agree_with_brute_force(spark):
    rng = random.Random(8)
    pool = [words(rng, rng.randrange(1, 9)) for _ in range(25)]
    vary = lambda s: rng.choice([s, s.upper(), "  " + s.replace(" ", "\t"), s + " "])
    texts = [rng.choice(["\n", ""]) + "\n".join(vary(rng.choice(pool)) for _ in range(rng.randrange(8))) for _ in range(60)]
    ids = rng.sample(range(1000), len(texts))
    seen, want = set(), {}
    for i, t in sorted(zip(ids, texts, strict=True)):
        kept, gone, own = [], 0, set()
        for line in t.split("\n"):
            norm = " ".join(line.lower().split())
            drop = len(norm.split()) >= 4 and (norm in seen or norm in own)
            own.add(norm)
            gone += drop
            kept.append((line, drop))
        seen |= own
        out, last = "", len(kept) - 1
        for n, (line, drop) in enumerate(kept):
            out += "" if drop else line + ("\n" if n < last else "")
        want[i] = (out, gone)
    got = {r["doc_id"]: r for r in lines.drop_repeated_lines(clashing(docs_frame(spark, texts, ids)), min_words=4).collect()}
    by_id = dict(zip(ids, texts, strict=True))
    for i, (out, gone) in want.items():
        assert (got[i]["text"], got[i]["n_removed"]) == (out, gone)
        assert "".join(by_id[i][s["start"]:s["end"]] for s in got[i]["kept"]) == out


def test_repeated_lines_odd_rows(spark):
    long = words(random.Random(1), 30)
    texts, ids = ODD_TEXTS + [long, long, long, long + "x"], ODD_IDS + [5, 5, None, 5]
    got = rows_of(lines.drop_repeated_lines(docs_frame(spark, texts, ids)).select("doc_id", "n_removed", "text"))
    assert got.count((5, 0, long)) == 2 and (None, 1, "") in got and len(got) == len(texts)
    assert (7, 0, "w " * 50_000) in got and (None, 0, None) in got
    assert lines.drop_repeated_lines(docs_frame(spark, texts, ids).limit(0)).count() == 0


def test_repeated_lines_of_rows_without_ids(spark):
    line = "a line of more than eight words that they all share"
    texts, ids = [f"first {i}\n{line}" for i in range(30)] + [f"none\n{line[2:]} once"], [None] * 31
    got = lines.drop_repeated_lines(docs_frame(spark, texts, ids)).collect()
    assert sorted(r["n_removed"] for r in got) == [0, 0] + [1] * 29
    named = lines.drop_repeated_lines(docs_frame(spark, texts, [9, *ids[1:]])).collect()
    assert {(r["doc_id"], r["n_removed"]) for r in named if line in r["text"]} == {(9, 0)}


def test_repeated_passages_agree_with_all_windows(spark):
    rng, size = random.Random(9), 12
    pool = [words(rng, rng.randrange(8, 30)).split() for _ in range(12)]
    texts = []
    for _ in range(60):
        w = []
        for _ in range(rng.randrange(4)):
            p = rng.choice(pool)
            w += words(rng, rng.randrange(6)).split() + p[rng.randrange(4):len(p) - rng.randrange(4)]
        texts.append("".join(rng.choice([x, x.upper()]) + rng.choice([" ", "\n", " \t"]) for x in w))
    texts += [texts[3], "", None, "\u00a0w " * 60, "W " * 70]
    ids = rng.sample(range(1000), len(texts) - 2) + [None, None]
    seen, want = set(), {}
    for i, t in sorted(zip(ids, texts, strict=True), key=lambda x: (x[0] is None, x[0] or 0)):
        w = "".join(c.lower() if c.isascii() else c for c in t or "").replace("\t", " ").replace("\n", " ").split(" ")
        w = [x for x in w if x]
        own = [tuple(w[k:k + size]) for k in range(len(w) - size + 1)]
        gone = {k + j for k, x in enumerate(own) if x in seen for j in range(size)}
        seen |= set(own)
        want[i, t] = [x for k, x in enumerate(w) if k not in gone], bool(gone)
    assert sum(hit for _, hit in want.values()) > 10
    frame = clashing(docs_frame(spark, texts, ids))
    starts = lines.repeated_windows(frame, passage=size, gram=5)
    assert starts.count() == sum(hit for _, hit in want.values())
    got = lines.drop_repeats(frame, passage=size, gram=5, min_words=4)
    old = lines.drop_repeated_lines(frame, min_words=4)
    assert rows_of(got.select("doc_id", "line_text", "line_removed", "line_kept", "n_lines_removed", "line_chars_removed")) == rows_of(old)
    by_id = {i: t for i, t in zip(ids, texts, strict=True) if i is not None}
    for r in got.where("doc_id is not null").collect():
        kept, hit = want[r["doc_id"], by_id[r["doc_id"]]]
        assert "".join(c.lower() if c.isascii() else c for c in r["text"] or "").replace("\t", " ").split() == " ".join(kept).split()
        assert bool(r["removed"]) == hit
        if hit:
            assert "".join(by_id[r["doc_id"]][s["start"]:s["end"]] for s in r["kept"]) == r["text"]


def test_passages_across_broken_lines_are_caught_and_short_lines_are_no_passages(spark):
    rng = random.Random(4)
    line = "a line of more than eight words that they all share"
    passage = words(rng, 60)
    texts = [f"one {passage} end\n{line}", f"{line}\ntwo " + passage.upper().replace(" ", "\n"), line, f"{line} x"]
    got = {r["doc_id"]: r for r in lines.drop_repeats(docs_frame(spark, texts, [1, 2, 3, 4])).collect()}
    assert [got[i]["n_removed"] for i in (1, 2, 3, 4)] == [0, 1, 0, 0] and got[2]["text"] == f"{line}\ntwo "
    assert [got[i]["n_lines_removed"] for i in (1, 2, 3, 4)] == [0, 1, 1, 0]
    assert lines.drop_repeats(docs_frame(spark, texts, [1, 2, 3, 4]).limit(0)).count() == 0


# ---------------------------------------------------------------- packing
def test_best_lengths_agree_with_all_choices():
    rng = random.Random(4)
    for _ in range(40):
        histogram = {rng.randrange(1, 40): rng.randrange(1, 9) for _ in range(rng.randrange(1, 9))}
        k = rng.randrange(1, 5)
        cost = lambda cuts: sum(n * (min(c for c in cuts if c >= x) - x) for x, n in histogram.items())  # noqa: B023, E731
        top = max(histogram)
        best = min(cost((*c, top)) for c in combinations([x for x in histogram if x != top], min(k, len(histogram)) - 1))
        got = packing.best_lengths(histogram, k)
        assert got[-1] == top and len(got) <= k and cost(got) == best
    assert packing.best_lengths({}, 3) == []


def test_packing_keeps_every_token(spark):
    rng = random.Random(6)
    texts = [words(rng, rng.randrange(0, 90)) for _ in range(200)] + ["", None, " \t "]
    docs = clashing(docs_frame(spark, texts))
    got = packing.pack(docs, context=32, buckets=4, budget=128, slice_rows=20).collect()
    pieces = {}
    for r in got:
        pieces.setdefault(r["doc_id"], []).append(r)
        assert r["n_tokens"] <= r["bucket_len"] <= 32 and r["padding"] == r["bucket_len"] - r["n_tokens"]
    for i, t in enumerate(texts):
        own = sorted(pieces[i], key=lambda r: r["piece"])
        assert sum(r["n_tokens"] for r in own) == len((t or "").split())
        assert [r["start_token"] for r in own] == [32 * k for k in range(len(own))]
    for length in {r["bucket_len"] for r in got}:
        per = max(1, 128 // length)
        places = sorted((r["batch"], r["row"]) for r in got if r["bucket_len"] == length)
        assert places == [(k // per, k % per) for k in range(len(places))]
    histogram = {}
    for r in got:
        n = max(1, r["n_tokens"])
        histogram[n] = histogram.get(n, 0) + 1
    assert {r["bucket_len"] for r in got} <= set(packing.best_lengths(histogram, 4))


def test_packing_odd_rows(spark):
    docs = docs_frame(spark, ODD_TEXTS, ODD_IDS)
    got = packing.pack(docs).groupBy("doc_id").sum("n_tokens").collect()
    assert {(r[0], r[1]) for r in got} >= {(7, 50_000), (1, 0), (3, 2)}
    assert packing.pack(docs.limit(0)).count() == 0


# ---------------------------------------------------------------- shards
def _key(i, t):
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    return int(md5(t or "")[:11], 16) * 65536 + int(md5("" if i is None else str(i))[:4], 16)


@pytest.mark.parametrize(("hot", "per_range"), [(False, 1000), (True, 1000), (True, 20)])
def test_shards_agree_with_the_exact_cut(spark, hot, per_range):
    rng = random.Random(9)
    texts = [words(rng, rng.randrange(0, 60)) for _ in range(600)] + [None, ""] + (["copy " * 40] * 400 if hot else [])
    ids = rng.sample(range(10_000), len(texts))
    docs = clashing(docs_frame(spark, texts, ids))
    got = {r["doc_id"]: r for r in shards.assign_shards(docs, 7, ranges_per_shard=4, rows_per_range=per_range).collect()}
    size = lambda t: len((t or "").encode()) + 16
    total, before, slots, loads = sum(map(size, texts)), 0, {}, [0] * 7
    for _, i, t in sorted((_key(i, t), i, t) for i, t in zip(ids, texts, strict=True)):
        shard = min(6, (2 * before + size(t)) * 7 // (2 * total))
        assert (got[i]["size"], got[i]["shard"], got[i]["slot"]) == (size(t), shard, slots.get(shard, 0))
        assert got[i]["text_crc32"] == zlib.crc32((t or "").encode())
        slots[shard] = slots.get(shard, 0) + 1
        before += size(t)
        loads[shard] += size(t)
    assert max(loads) - min(loads) <= 2 * max(map(size, texts))


def test_ranges_have_bounded_rows(spark):
    rows = shards.records(docs_frame(spark, ["same text"] * 3000 + [words(random.Random(i), 9) for i in range(1000)]))
    total = rows.agg({"size": "sum"}).first()[0]
    _, sums = shards.split_ranges(rows, total, 4, rows_per_range=100)
    assert sum(r[2] for r in sums) == 4000 and max(r[2] for r in sums) <= 200


def test_shards_odd_rows(spark):
    docs = docs_frame(spark, ODD_TEXTS, ODD_IDS)
    got = shards.assign_shards(docs, 40).collect()
    assert len(got) == len(ODD_TEXTS)
    for s in {r["shard"] for r in got}:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    assert shards.assign_shards(docs.limit(0), 40).count() == 0


def test_write_shards(spark, workdir):
    docs = docs_frame(spark, [f"text {i}" for i in range(50)])
    shards.write_shards(docs, workdir + "/out", 3)
    back = spark.read.parquet(workdir + "/out")
    assert back.count() == 50 and back.select("shard").distinct().count() == 3
