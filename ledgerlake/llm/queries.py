"""Registered queries of the training-data operators (``opN_<name>``) with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import bpe, centroids, spelling, suffix_tree, toxicity
from ledgerlake.llm.common import fold, table
from ledgerlake.llm.decontaminate import find_hits
from ledgerlake.llm.imatch import fingerprints
from ledgerlake.llm.lines import drop_repeats
from ledgerlake.llm.minhash import near_duplicates
from ledgerlake.llm.packing import pack
from ledgerlake.llm.pii import KINDS, find_personal_data
from ledgerlake.llm.shards import assign_shards
from ledgerlake.llm.url_rules import judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------- 1. toxicity
def may_learn_toxicity(doc_id):
    return fold(doc_id, 3) != 1


@register("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned from the labels outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), allowed=may_learn_toxicity)
    scored = toxicity.score_texts(docs, model)
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"), "threshold", "rejected")


# ---------------------------------------------------------------- 2. repeated lines
@register("op2_repeated_lines")
def op2_repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages of over 50 words that an earlier document has, and (line_...) without the lines that an
    earlier document, or an earlier line of its own, has."""
    return drop_repeats(table(spark, sf_dir, "documents"))


# ---------------------------------------------------------------- 3. packing
@register("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in length buckets and token-budget batches."""
    return pack(table(spark, sf_dir, "documents"))


# ---------------------------------------------------------------- 4. URL rules
URL_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
             ("block", "net", "/es/"), ("block", "net", "/fr/")]


@register("op4_url_rules", """
WITH rules(action, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
rest AS (SELECT row_number() OVER () AS rn, page_id,
  CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT rn, page_id, regexp_extract(r, '^[^/?#]*') AS raw,
  regexp_extract(substr(r, length(regexp_extract(r, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM rest),
urls AS (SELECT rn, page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM parts),
fits AS (SELECT u.rn, arg_max(h || p, length(h || p)) AS rule, arg_max(action, length(h || p)) AS action
  FROM urls u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY u.rn)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM urls LEFT JOIN fits USING (rn)""")
def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url against the contract's rules; urls that no rule fits are allowed."""
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


# ---------------------------------------------------------------- 5. language-model scores
@register("op5_suffix_tree")
def op5_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log probability under a suffix tree learned from the documents outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    tree, counts = suffix_tree.learn(docs.where(fold("doc_id", 5) != 1).select("text"), keep_levels=False)
    scored = suffix_tree.score_texts(docs, tree, counts)
    return scored.select("doc_id", (fold("doc_id", 5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


# ---------------------------------------------------------------- 6. personal data
@register("op6_personal_data")
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers and risky terms of every document; counts and a digest of the identifiers."""
    found = find_personal_data(table(spark, sf_dir, "documents"))
    joined = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of_kind = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", *[of_kind(k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(*KINDS))), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


# ---------------------------------------------------------------- 7. fingerprints
_LEXICONS = [f"(v[{f + 1}] < {65536 // 4 ** s})" for f in range(8) for s in range(1, 5)] + ["true"]


def _entry_sql(k: int) -> str:
    own = f"list_filter(kept, lambda x: x.m[{k + 1}])"
    return (f"CAST(len({own}) AS VARCHAR) || ':' || CASE WHEN len({own}) > 0 THEN "
            f"substr(md5(array_to_string(list_transform({own}, lambda x: x.t), ' ')), 1, 16) ELSE '-' END")


def _likeness_sql(a: str, b: str) -> str:
    count = lambda e: f"CAST(split_part({e}, ':', 1) AS INTEGER)"
    most = f"greatest({count('p[1]')}, {count('p[2]')})"
    pairs = f"list_zip(string_split({a}, ','), string_split({b}, ','))"
    weights = lambda cond: f"list_sum(list_transform({pairs}, lambda p: CASE WHEN {most} > 0{cond} THEN 1000000 // {most} ELSE 0 END))"
    return f"CASE WHEN {weights('')} > 0 THEN CAST({weights(' AND p[1] = p[2]')} AS DOUBLE) / CAST({weights('')} AS DOUBLE) ELSE 1.0 END"


_PRINT = ("CASE WHEN len(kept) = 0 THEN array_to_string(list_transform(range(33), lambda i: fallback), ',') ELSE concat_ws(',', "
          + ", ".join(_entry_sql(k) for k in range(33)) + ") END")


@register("op7_imatch", """
WITH d0 AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id) AS rn FROM documents),
d1 AS (SELECT *, coalesce(lead(text) OVER (ORDER BY rn), first_value(text) OVER (ORDER BY rn)) AS nxt FROM d0),
d2 AS (SELECT rn, doc_id, length(text) AS n, text,
  substr(text, 1, length(text) - length(text) // 4) || substr(nxt, 1, length(text) // 4) AS edited FROM d1),
tx AS (SELECT rn, 1 AS kind, text AS t FROM d2 UNION ALL SELECT rn, 2, edited FROM d2),
tw AS (SELECT rn, kind, list_sort(list_distinct(list_filter(regexp_split_to_array(
  translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> ''))) AS w FROM tx),
lex AS (SELECT term, v, [LEX] AS m FROM (SELECT term, list_transform(range(8),
    lambda i: ('0x' || substr(md5(term), 4 * i + 1, 4))::INTEGER) AS v
  FROM (SELECT unnest(w) AS term FROM tw WHERE kind = 1) GROUP BY term
  HAVING count(*) BETWEEN 0.002 * (SELECT count(*) FROM documents) AND 0.05 * (SELECT count(*) FROM documents))),
kept AS (SELECT rn, kind, list({'t': term, 'm': m} ORDER BY term) AS kept
  FROM (SELECT rn, kind, unnest(w) AS term FROM tw) JOIN lex USING (term) GROUP BY rn, kind),
kp AS (SELECT tw.rn, tw.kind, coalesce(kept.kept, []) AS kept,
  CASE WHEN len(w) > 0 THEN '1:' || substr(md5(array_to_string(w, ' ')), 1, 16) ELSE '0:-' END AS fallback
  FROM tw LEFT JOIN kept USING (rn, kind)),
fp AS (SELECT rn, kind, PRINT AS fp FROM kp),
o AS (SELECT rn, fp, lead(fp) OVER (ORDER BY rn) AS nf FROM fp WHERE kind = 1),
al AS (SELECT d2.doc_id, n, edited, o.fp, e.fp AS efp, coalesce(o.nf, first_value(o.fp) OVER (ORDER BY d2.rn)) AS nfp
  FROM d2 JOIN o USING (rn) JOIN fp e ON e.rn = d2.rn AND e.kind = 2)
SELECT doc_id, CAST(n AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256, fp AS fingerprint, efp AS edited_fingerprint,
  NEAR1 AS near_edited, NEAR2 AS near_next FROM al"""
          .replace("[LEX]", "[" + ", ".join(_LEXICONS) + "]")
          .replace("PRINT", _PRINT).replace("NEAR1", _likeness_sql("fp", "efp")).replace("NEAR2", _likeness_sql("fp", "nfp")))
def op7_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I-Match fingerprints of every document and its edited text, with their likeness."""
    return fingerprints(table(spark, sf_dir, "documents"))


# ---------------------------------------------------------------- 8. near-duplicates
@register("op8_minhash", """
WITH RECURSIVE w AS (SELECT row_number() OVER () AS rn, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT rn, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g FROM w),
n AS (SELECT rn, count(*) AS n FROM s GROUP BY rn),
links AS (SELECT a.rn AS a, b.rn AS b FROM s a JOIN s b ON a.g = b.g AND a.rn <> b.rn JOIN n na ON na.rn = a.rn JOIN n nb ON nb.rn = b.rn
  WHERE 100 * least(na.n, nb.n) >= 80 * greatest(na.n, nb.n) GROUP BY a.rn, b.rn, na.n, nb.n
  HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
comp AS (SELECT w.rn, w.doc_id, least(w.doc_id, min(o.doc_id)) AS c FROM w LEFT JOIN reach ON reach.a = w.rn
  LEFT JOIN w o ON o.rn = reach.b GROUP BY w.rn, w.doc_id)
SELECT comp.doc_id, coalesce(n.n, 0) AS n_shingles, c AS component_id, doc_id = c AS kept FROM comp LEFT JOIN n USING (rn)""")
def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents on 2-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=2).drop("t1", "t2", "root")


# ---------------------------------------------------------------- 9. shards
@register("op9_shards")
def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 40 shards of near-equal bytes."""
    placed = assign_shards(table(spark, sf_dir, "documents"), shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


# ---------------------------------------------------------------- 10. benchmark decontamination
@register("op10_decontaminate", """
WITH d AS (SELECT doc_id, row_number() OVER () AS rn, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w FROM benchmark),
pat AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM pat),
win AS (SELECT rn, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT rn, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
hits AS (SELECT win.rn, win.i, win.n, pat.item_id FROM win JOIN pat ON win.s = pat.s AND win.n = pat.n),
words AS (SELECT rn, count(DISTINCT p) AS n_hit FROM (SELECT rn, unnest(range(i, i + n)) AS p FROM hits) GROUP BY rn),
its AS (SELECT rn, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s
  FROM (SELECT DISTINCT rn, item_id FROM hits) GROUP BY rn)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (rn) LEFT JOIN its USING (rn)""")
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie inside a 10-word window of a benchmark item."""
    hits = find_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                       F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                       (F.col("n_hit") > 0).alias("contaminated"))


# ---------------------------------------------------------------- 11. BPE
BPE_FILE = public_tokenizers.path("byte_bpe_50k.json")


@register("op11_bpe")
def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids, and the text decoded from them."""
    vocabulary = bpe.Vocabulary.load(BPE_FILE)
    coded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), vocabulary), vocabulary)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2("text", 256).alias("decoded_sha256"))


# ---------------------------------------------------------------- 12. centroid clustering
def _rounds_sql(rounds: int) -> str:
    """Assignments and centroids of each round; the last assignment is ``a<rounds>``."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT rn, vec_id, v, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT rn, vec_id, v, c,
  CAST(list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM kept, c{r}) GROUP BY rn, vec_id, v)""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (SELECT c{r}.c, coalesce(n.m, c{r}.m) AS m FROM c{r} LEFT JOIN (SELECT c, list(m ORDER BY i) AS m FROM (
  SELECT c, i, CAST((CAST(sum(x) AS HUGEINT) - (((CAST(sum(x) AS HUGEINT) % count(*)) + count(*)) % count(*))) // count(*) AS BIGINT) AS m
  FROM (SELECT c, unnest(v) AS x, unnest(range(64)) AS i FROM a{r}) GROUP BY c, i) GROUP BY c) n ON n.c = c{r}.c)""")
    return ",\n".join(steps)


@register("op12_centroids", f"""
WITH raw AS (SELECT row_number() OVER () AS rn, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings WHERE len(embedding) = 64),
kept AS MATERIALIZED (SELECT rn, vec_id, list_transform(e, lambda x: CAST(floor(64 * x) AS BIGINT)) AS v FROM raw
  WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v AS m
  FROM (SELECT v, sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM kept ORDER BY h, v LIMIT 16)),
{_rounds_sql(3)},
s AS (SELECT c, CAST(sum(d) AS BIGINT) AS s FROM a3 GROUP BY c)
SELECT vec_id, CAST(a3.c AS INTEGER) AS cluster, d AS distance, s.s AS cluster_inertia,
  (SELECT CAST(sum(s) AS BIGINT) FROM s) AS inertia, sha256(array_to_string(c3.m, ',')) AS centroid_sha256
FROM a3 JOIN s USING (c) JOIN c3 USING (c)""")
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's cluster after three rounds of 16 centroids, with exact distances."""
    return centroids.report(centroids.cluster(table(spark, sf_dir, "embeddings"), k=16, rounds=3, dim=64))


# ---------------------------------------------------------------- 13. spelling variants
@register("op13_spelling")
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of at least 7 letters with its nearest more frequent spelling, after one error dealt into every 31st occurrence."""
    words = spelling.count_words(table(spark, sf_dir, "documents"), min_letters=7, min_count=2, error_every=31)
    return spelling.group_variants(words, factor=10)
