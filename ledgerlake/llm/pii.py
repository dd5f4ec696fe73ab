"""PII: patterns for direct identifiers, and information-theoretic sanitisation of terms that reveal them.

Direct identifiers (emails, IPv4 addresses, card numbers, phone numbers) are found by
fixed patterns.  Each distinct value is a protected entity e, and so are the coarser ones
that recur: an email's local part and its domain, and an address' network (its first
three numbers).  The kind is none: the placeholders show it.  Corpus co-occurrence then
estimates how much a term t reveals e:

    IC(e) = -log2(texts with e / N),   PMI(t, e) = log2(P(e | t) / P(e)),   disclosure = max over e of PMI / IC

P(e | t) is estimated as (n_te + P(e)) / (n_t + 1): n_te distinct texts have t within
``NEAR`` words of e, n_t have t, and one more text is assumed that has e by chance.  So
little evidence counts for less and none is cut off.  All counts, N included, are of
distinct texts, so copies of a text change nothing.  A term that reaches ``GENERALISE``
is generalised wherever it stands; from ``REMOVE`` on it is removed.

All statistics cover all documents; terms are counted in one pass.  Risky terms are dealt
into parts of at most about ``MAX_TERMS`` terms; each part is broadcast and marked over
all documents, so their number has no cap.

Defined results: a null or empty text has no spans (and stays null or empty when
sanitised); repeated rows are judged each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import byte_slices, pick, staged, table_of
from ledgerlake.llm.suffix_tree import _bit_table as bit_table
from ledgerlake.llm.suffix_tree import _may_have as may_have

NEAR = 8                  # words on each side of an entity
SUPPORT = 1               # distinct texts in which a term is near the entity: 1 cuts none off
GENERALISE = 0.9
REMOVE = 0.98
MAX_TERMS = 500_000
FLUSH = 500_000           # terms a task holds before it passes partial sums on

# Fixed patterns of the direct identifiers.
_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
_IP = r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)"
_CARD = r"[0-9]([\x20-]?[0-9])+"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone")
TERM_KINDS = ("term_generalised", "term_removed")

_EMAIL_HERE = re.compile(_EMAIL)
_EMAIL_NEXT = re.compile(r"(?<![A-Za-z0-9._%+-])" + _EMAIL)
_RE = {"ip": re.compile(_IP), "card": re.compile(_CARD), "phone": re.compile(_PHONE)}
_DIGIT = re.compile(rb"[0-9]")
_TERM = re.compile("[A-Za-z\x80-\U0010ffff]+")
# A-Z to a-z; ASCII letters and all bytes from 0x80 stay; the rest separates terms.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As ``finditer`` would, but a start is tried inside a run of local-part characters only right after a match."""
    m, at = None, 0
    while True:
        m = (_EMAIL_HERE.match(text, at) if at else None) or _EMAIL_NEXT.search(text, at)
        if m is None:
            return
        yield m.span()
        at = m.end()


def base_spans(text: bytes) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, normalised value) in code points, by kind, then start."""
    out: list[tuple[str, int, int, str]] = []
    has_at, has_digit = b"@" in text, _DIGIT.search(text) is not None
    if not has_at and not has_digit:
        return out
    t = text.decode()
    if has_at:
        out += [("email", a, b, t[a:b].lower()) for a, b in _emails(t)]
    if has_digit:
        if "." in t:
            for m in _RE["ip"].finditer(t):
                parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
                if all(len(p) <= 3 and int(p) <= 255 for p in parts):
                    out.append(("ip", *m.span(), ".".join(parts)))
        for m in _RE["card"].finditer(t):
            digits = _only_digits(m.group())
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", *m.span(), digits))
        if "+" in t:
            for m in _RE["phone"].finditer(t):
                digits = _only_digits(m.group())
                if 9 <= len(digits) <= 15:
                    out.append(("phone", *m.span(), digits))
    return out


def entities_of(kind: str, value: str) -> list[str]:
    """The identifier itself and what it shares with others."""
    out = [f"{kind}:{value}"]
    if kind == "email":
        local, domain = value.split("@")
        out += [f"local:{local}", f"domain:{domain}"]
    elif kind == "ip":
        out.append(f"network:{value.rpartition('.')[0]}")
    return out


def _near_terms(text: str, spans: list[tuple[str, int, int, str]]) -> Iterator[tuple[str, str]]:
    """(entity, term) for the NEAR terms on each side of each span; terms inside identifiers do not count."""
    taken = sorted((a, b) for _, a, b, _ in spans)
    words = []
    at = 0
    for m in _TERM.finditer(text):
        a, b = m.span()
        while at < len(taken) and taken[at][1] <= a:
            at += 1
        if not (at < len(taken) and taken[at][0] < b):
            words.append((a, m.group()))
    starts = [a for a, _ in words]
    for kind, a, b, value in spans:
        left, right, entities = bisect_left(starts, a), bisect_left(starts, b), entities_of(kind, value)
        for _, word in words[max(0, left - NEAR):left] + words[right:right + NEAR]:
            for entity in entities:
                yield entity, word.encode().lower().decode()


_PAIRS = {"text_key": pa.int64(), "entity": pa.int64(), "term": pa.string()}


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in byte_slices(batch):
            out: dict[str, list] = {k: [] for k in _PAIRS}
            for key, t in zip(part.column("text_key").to_pylist(), texts, strict=True):
                if spans := base_spans(t):
                    for entity, term in set(_near_terms(t.decode(), spans)):
                        out["text_key"].append(key)
                        out["entity"].append(xxhash.xxh3_64_intdigest(entity.encode()) - (1 << 63))
                        out["term"].append(term)
            yield table_of(_PAIRS, out)


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial sums by term of the rows' weights."""
    n: Counter = Counter()

    def flush() -> pa.RecordBatch:
        out = table_of({"term": pa.string(), "texts": pa.float64()}, {"term": [t.decode() for t in n], "texts": [float(v) for v in n.values()]})
        n.clear()
        return out

    for batch in batches:
        for part, texts in byte_slices(batch):
            for copies, t in zip(part.column("copies").to_pylist(), texts, strict=True):
                found = set(t.translate(_LETTERS).split())
                if copies == 1:
                    n.update(found)
                else:
                    for term in found:
                        n[term] += 1 / copies
            if len(n) > FLUSH:
                yield flush()
    yield flush()


def _may_be_copy(shared):
    """Whether a text may stand in several rows; only such texts need the join that says how many."""
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for keys in batches:
            yield pa.array(may_have(shared.value, keys.to_numpy(zero_copy_only=False)))
    return F.arrow_udf(find, "boolean")


def _shared_parts(terms: DataFrame, columns: list[str], max_terms: int) -> list:
    """The rows of ``terms`` in broadcasts of about ``max_terms`` rows."""
    n = max(1, -(-terms.count() // max_terms))
    context = terms.sparkSession.sparkContext
    parts = (terms.where(F.pmod(F.xxhash64("term"), F.lit(n)) == k).select(*columns).collect() for k in range(n))
    return [context.broadcast([tuple(r) for r in rows]) for rows in parts]


def risky_terms(docs: DataFrame, text_col: str = "text", support: int = SUPPORT, generalise: float = GENERALISE,
                remove: float = REMOVE, max_terms: int = MAX_TERMS) -> DataFrame:
    """term, disclosure, kind (term_generalised or term_removed) for the terms that exceed a threshold."""
    rows = pick(docs, text=text_col).withColumn("text_key", F.xxhash64("text"))
    copies = rows.groupBy("text_key").agg(F.count(F.lit(1)).alias("copies"))
    copies = staged(copies, "pii-texts")
    n_texts = copies.count()
    pairs = staged(rows.mapInArrow(
        _pairs, "text_key long, entity long, term string").distinct(), "pii-pairs")
    texts_with = pairs.select("entity", "text_key").distinct().groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"))
    near = pairs.groupBy("term", "entity").agg(F.count(F.lit(1)).alias("n_te")).where(F.col("n_te") >= support)
    near = staged(near.join(texts_with, "entity"), "pii-near")
    # each row counts one over its text's copies, so a text counts once; sums are whole numbers but for rounding
    several = copies.where("copies > 1")
    may = _may_be_copy(rows.sparkSession.sparkContext.broadcast(bit_table(several.select(F.col("text_key").alias("key")))))
    rows = rows.withColumn("may", may("text_key"))
    met = rows.where("may").join(several, "text_key", "left").select("text", F.coalesce("copies", F.lit(1).cast("long")).alias("copies"))
    weighed = rows.where("not may").select("text", F.lit(1).cast("long").alias("copies")).unionByName(met)
    df = weighed.mapInArrow(_count_terms, "term string, texts double").groupBy("term").agg(F.round(F.sum("texts")).alias("df"))
    ic = -F.log2(F.col("n_e") / F.lit(float(max(1, n_texts))))
    pmi = F.log2((F.col("n_te") + F.col("n_e") / F.lit(float(max(1, n_texts)))) / (F.col("df") + 1)) + ic
    scored = near.join(df, "term").where(ic > 0).groupBy("term").agg(F.max(pmi / ic).alias("disclosure"))
    return staged(scored.where(F.col("disclosure") >= generalise).withColumn(
        "kind", F.when(F.col("disclosure") >= remove, TERM_KINDS[1]).otherwise(TERM_KINDS[0])), "pii-risky")


def all_spans(text: bytes, risky: dict[bytes, str]) -> list[tuple[str, int, int]]:
    """Base spans, then spans of risky terms outside them, by kind, then start."""
    base = base_spans(text)
    out = [s[:3] for s in base]
    if risky and not risky.keys().isdisjoint(text.translate(_LETTERS).split()):
        taken = sorted((a, b) for _, a, b, _ in base)
        found, at = [], 0
        for m in _TERM.finditer(text.decode()):
            a, b = m.span()
            while at < len(taken) and taken[at][1] <= a:
                at += 1
            kind = risky.get(m.group().encode().lower())
            if kind and not (at < len(taken) and taken[at][0] < b):
                found.append((kind, a, b))
        out += sorted(found)
    return out


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_SPANS_DDL = "array<struct<kind:string,start:long,end:long>>"


def _finder(shared):
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        risky = {t.encode(): kind for t, kind in shared.value}
        for texts in batches:
            yield pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in all_spans(t or b"", risky)]
                            for t in texts.cast(pa.binary()).to_pylist()], _SPANS)
    return F.arrow_udf(find, _SPANS_DDL)


def _is_kind(kind: str):
    return lambda s: s["kind"] == kind


def _with_spans(rows: DataFrame, text: str, out: str, risky: DataFrame, max_terms: int) -> DataFrame:
    """Column ``out``: the spans of every part of the risky terms, united."""
    finders = [_finder(shared)(F.col(text)) for shared in _shared_parts(risky, ["term", "kind"], max_terms)]
    rows = rows.withColumn(out, finders[0])
    for more in finders[1:]:
        rows = rows.withColumn(out, F.array_union(out, more))
    if len(finders) > 1:                      # bring the parts' terms into one order
        base = F.filter(out, lambda s: s["kind"].isin(*KINDS))
        terms = [F.array_sort(F.filter(out, _is_kind(k))) for k in TERM_KINDS]
        rows = rows.withColumn(out, F.concat(base, *terms))
    return rows


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_terms: int = MAX_TERMS,
                       **thresholds) -> DataFrame:
    """One row per document: doc_id, spans (kind, start, end; by kind as listed, then start)."""
    rows = pick(docs, doc_id=id_col, text=text_col)
    rows = _with_spans(rows, "text", "spans", risky_terms(docs, text_col, max_terms=max_terms, **thresholds), max_terms)
    return rows.select("doc_id", "spans")


def _clean(text: str | None, spans: list[dict]) -> str | None:
    if not text or not spans:
        return text
    out, last = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= last:
            out += [text[last:s["start"]], "" if s["kind"] == "term_removed" else f"[{s['kind'].removesuffix('_generalised').upper()}]"]
        last = max(last, s["end"])
    return "".join([*out, text[last:]])


def _sanitised(texts: pa.Array, spans: pa.Array) -> pa.Array:
    return pa.array([_clean(t, s) for t, s in zip(texts.to_pylist(), spans.to_pylist(), strict=True)], pa.string())


def sanitise(docs: DataFrame, text_col: str = "text", max_terms: int = MAX_TERMS, **thresholds) -> DataFrame:
    """The same rows and columns; identifiers and generalised terms become placeholders, removed terms go."""
    risky = risky_terms(docs, text_col, max_terms=max_terms, **thresholds)
    names, at = docs.columns, docs.columns.index(text_col)
    flat = _with_spans(docs.toDF(*[f"_c{i}" for i in range(len(names))]), f"_c{at}", "_spans", risky, max_terms)
    return flat.withColumn(f"_c{at}", F.arrow_udf(_sanitised, "string")(f"_c{at}", "_spans")).drop("_spans").toDF(*names)
