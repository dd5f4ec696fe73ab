"""I-Match fingerprints in DataFrame operations only: hashed sets of mid-frequency terms over randomised lexicons.

Terms are the distinct words of a text, A-Z lower-cased.  The lexicon holds the terms
whose share of documents lies between ``LOW`` and ``HIGH`` (a band of inverse document
frequency).  A share of at least ``LOW`` bounds the lexicon by (mean terms per document /
LOW) terms whatever the input's size, so it is broadcast.  Randomised lexicons: the 32
hex digits of a term's md5 are 8 numbers of 16 bits; family f keeps the term at rate
4^-s if number f is below 65536 / 4^s, s = 1 to 4.  With the whole band that makes 33
lexicons, some of which keep one to three terms of a text of any length.  For each one
the text's kept terms are sorted and hashed; a text without any term of the band uses
all its terms.  The fingerprint lists ``count:hash`` by lexicon.  The likeness of two
fingerprints is the weight of the lexicons whose hashes agree; a lexicon weighs
1 / (the greater count of kept terms), so each one speaks for about one term.

The edited text of a document ends with the beginning of the next one (ascending id).
Ids are dealt into ranges at their quantiles, and the first document of a range is also
sent to the range before it, so every document meets its neighbour and texts move once.

Defined results: a null text counts as empty; texts without terms have likeness 1 to
each other and 0 to others; rows that share an id are ordered by a hash of their text;
null ids come first; a single document is its own next one; an empty table gives an
empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import pick, staged

LOW, HIGH = 0.002, 0.05
FAMILIES, SCALES = 8, 4
LEXICONS = FAMILIES * SCALES + 1
ROWS_PER_RANGE = 2_000
MAX_RANGES = 100_000
WEIGHT = 1_000_000            # of a lexicon that keeps one term; whole numbers, so sums do not depend on order


def terms(text: Column) -> Column:
    """Distinct words, A-Z lower-cased."""
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(          # the same, but cheap, for ASCII
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return F.array_distinct(F.array_remove(F.split(low, r"[\x20\x09-\x0D]+"), ""))


def _masks(term: Column) -> Column:
    """Bit f * SCALES + s - 1: family f keeps the term at scale s; the last bit: the whole band."""
    digest = F.md5(term.cast("binary"))
    bits = [F.lit(1 << (LEXICONS - 1)).cast("long")]
    for f in range(FAMILIES):
        value = F.conv(F.substring(digest, 4 * f + 1, 4), 16, 10).cast("int")
        bits += [F.when(value < 65536 // 4 ** s, F.lit(1 << (f * SCALES + s - 1)).cast("long")).otherwise(F.lit(0).cast("long"))
                 for s in range(1, SCALES + 1)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def lexicon(docs: DataFrame, text_col: str = "text", low: float = LOW, high: float = HIGH) -> DataFrame:
    """term and mask of every word in the band of document share (over all documents)."""
    rows = pick(docs, text=text_col)
    n = rows.count()
    counts = rows.select(F.explode(terms(F.coalesce("text", F.lit("")))).alias("term")) \
        .groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    return counts.where((F.col("df") >= low * n) & (F.col("df") <= high * n)).select("term", _masks(F.col("term")).alias("mask"))


def _digest(sorted_terms: Column) -> Column:
    return F.substring(F.md5(F.array_join(sorted_terms, " ").cast("binary")), 1, 16)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _entry(kept: Column) -> Column:
    some = F.size(kept)
    return F.concat(some.cast("string"), F.lit(":"), F.when(some > 0, _digest(F.transform(kept, lambda x: x["term"]))).otherwise("-"))


def _nested(kept: Column, family: int, scale: int) -> Column:
    """Entries of a family's scales from ``scale`` on; each scale keeps some of what the one before kept."""
    bit = F.lit(1 << (family * SCALES + scale - 1))
    own = F.filter(kept, lambda x: x["mask"].bitwiseAND(bit) != 0)
    if scale == SCALES:
        return F.array(_entry(own))
    return _let(own, lambda v: F.concat(F.array(_entry(v)), _nested(v, family, scale + 1)))


def _fingerprint(kept: Column, fallback: Column) -> Column:
    """``kept``: structs (term, mask) sorted by term; ``fallback``: entry for texts without terms of the band."""
    entries = F.concat(*[_nested(kept, f, 1) for f in range(FAMILIES)], F.array(_entry(kept)))
    return F.when(F.size(kept) > 0, F.array_join(entries, ",")).otherwise(F.array_join(F.array_repeat(fallback, LEXICONS), ","))


def _fallback(distinct: Column) -> Column:
    return F.when(F.size(distinct) > 0, F.concat(F.lit("1:"), _digest(F.array_sort(distinct)))).otherwise("0:-")


def likeness(a: Column, b: Column) -> Column:
    """Weight of the agreeing lexicons over the weight of all that keep something; 1 if none does."""
    count = lambda e: F.substring_index(e, ":", 1).cast("int")
    pairs = F.zip_with(F.split(a, ","), F.split(b, ","), lambda x, y: F.struct(
        F.when(F.greatest(count(x), count(y)) > 0, F.floor(F.lit(WEIGHT) / F.greatest(count(x), count(y)))).otherwise(F.lit(0)).cast("long").alias("w"),
        (x == y).alias("same")))
    total = F.aggregate(pairs, F.struct(F.lit(0).cast("long").alias("same"), F.lit(0).cast("long").alias("all")),
                        lambda s, p: F.struct((s["same"] + F.when(p["same"], p["w"]).otherwise(F.lit(0).cast("long"))).alias("same"),
                                              (s["all"] + p["w"]).alias("all")),
                        lambda s: F.when(s["all"] > 0, s["same"].cast("double") / s["all"].cast("double")).otherwise(F.lit(1.0)))
    return total


def _cuts(rows: DataFrame, rows_per_range: int) -> tuple[list[int], int]:
    """Ascending lower ends of the ranges after the first, each an id that occurs, and the least id."""
    n, least = rows.agg(F.count(F.lit(1)), F.min("pos")).first()
    ranges = max(1, min(MAX_RANGES, n // rows_per_range))
    if ranges == 1:
        return [], least
    shares = [i / ranges for i in range(1, ranges)]
    at = rows.agg(F.percentile_approx("pos", shares, max(10_000, 20 * ranges))).first()[0]
    return sorted(set(at) - {least}), least


def _range_of(pos: Column, cuts: list[int]) -> Column:
    """Number of cuts at or below ``pos``, found by blocks so that long lists stay cheap."""
    if not cuts:
        return F.lit(0)
    block = max(1, int(len(cuts) ** 0.5))
    blocks = [cuts[i:i + block] for i in range(0, len(cuts), block)]
    as_array = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    below = lambda xs: F.size(F.filter(xs, lambda c: c <= pos))
    whole = F.greatest(F.lit(0), below(as_array([b[0] for b in blocks])) - 1)
    return whole * block + below(F.get(F.array(*[as_array(b) for b in blocks]), whole))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """range, rn (unique in a range), doc_id, text, next_text; rows with ``copy`` are the first document of the next range."""
    rows = pick(docs, doc_id=id_col, text=text_col).select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("pos"))
    cuts, least = _cuts(rows.select("pos"), rows_per_range)
    last = len(cuts)
    rows = rows.withColumn("range", _range_of(F.col("pos"), cuts))
    place = lambda r, copy: F.struct(r.cast("int").alias("range"), F.lit(copy).alias("copy"))
    own = F.array(place(F.col("range"), False))
    starts = F.array(*[F.lit(c).cast("long") for c in [least if least is not None else 0, *cuts]])
    before = F.when(F.col("range") == 0, F.lit(last)).otherwise(F.col("range") - 1)
    rows = rows.withColumn("to", F.when(F.get(starts, F.col("range")) == F.col("pos"), F.concat(own, F.array(place(before, True)))).otherwise(own))
    w = Window.partitionBy("range").orderBy("copy", "pos", "h")
    return rows.select("doc_id", "text", "pos", F.xxhash64("text").alias("h"), F.explode("to").alias("to")) \
        .select("doc_id", "text", "pos", "h", "to.range", "to.copy") \
        .withColumn("next_text", F.lead("text").over(w)).withColumn("rn", F.row_number().over(w))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", low: float = LOW, high: float = HIGH) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    words = F.broadcast(staged(lexicon(docs, text_col, low, high), "imatch-lexicon"))
    rows = with_next(docs, id_col, text_col)
    n = F.length("text")
    k = F.floor(n / 4).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), n - k), F.col("next_text").substr(F.lit(1), k))
    rows = rows.withColumn("edited", edited)
    own, changed = terms(F.col("text")), terms(F.coalesce("edited", F.lit("")))
    rows = rows.select("range", "rn", own.alias("own"), changed.alias("changed"), F.struct(
        "copy", "doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256")).alias("facts"))
    # one row of facts (with a term no text has) and one per term, which says whose it is (1 own, 2 edited, 3 both);
    # terms outside the lexicon end at the join
    entry = lambda ts, whose: F.transform(ts, lambda t: F.struct(t.alias("term"), F.lit(whose).alias("whose")))
    facts = F.struct("facts", _fallback(F.col("own")).alias("own"), _fallback(F.col("changed")).alias("changed"))
    each = rows.select("range", "rn", facts.alias("facts"), F.explode(F.concat(
        entry(F.array(F.lit("")), 0), entry(F.array_intersect("own", "changed"), 3), entry(F.array_except("own", "changed"), 1),
        entry(F.array_except("changed", "own"), 2))).alias("e")) \
        .select("range", "rn", F.when(F.col("e.whose") == 0, F.col("facts")).alias("facts"), "e.term", "e.whose")
    none = words.sparkSession.range(1).select(F.lit("").alias("term"), F.lit(0).cast("long").alias("mask"))
    met = each.join(F.broadcast(words.unionByName(none)), "term")
    docs_met = met.groupBy("range", "rn").agg(F.first("facts", ignorenulls=True).alias("f"), F.array_sort(F.collect_list(
        F.when(F.col("whose") > 0, F.struct("term", "mask", "whose")))).alias("met"))
    of = lambda bit: F.filter("met", lambda x: x["whose"].bitwiseAND(F.lit(bit)) != 0)
    kept = docs_met.select("range", "rn", "f", of(1).alias("own"), of(2).alias("changed"))
    prints = kept.select("range", "rn", "f.facts.*", _fingerprint(F.col("own"), F.col("f.own")).alias("fingerprint"),
                         _fingerprint(F.col("changed"), F.col("f.changed")).alias("edited_fingerprint"))
    w = Window.partitionBy("range").orderBy("rn")
    return prints.withColumn("next_fingerprint", F.lead("fingerprint").over(w)).where("not copy").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
