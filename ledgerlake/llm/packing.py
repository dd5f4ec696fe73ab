"""Packing into optimal length buckets: dynamic programming over the global length histogram.

A document's words (runs without blank space) are its tokens.  Documents longer than
``context`` are cut into pieces of ``context`` tokens and a rest, so no token is
dropped and the histogram has at most ``context`` bins, whatever the input's size.
The program chooses ``buckets`` upper lengths that minimise the tokens of padding
when each piece is padded to its bucket.  Inside a bucket pieces are numbered and cut
into batches of ``budget`` padded tokens.  Numbers come from counts by (bucket, slice)
of bounded slices, so no task sorts a whole bucket.

Defined results: a null, empty or blank text has one piece of 0 tokens in the first
bucket; repeated rows are packed each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import pick, staged

CONTEXT = 2048
BUCKETS = 8
BUDGET = 65_536
SLICE_ROWS = 50_000


def best_lengths(histogram: dict[int, int], buckets: int) -> list[int]:
    """Ascending bucket lengths with the least total padding; the last is the greatest length."""
    lengths = np.array(sorted(histogram), np.int64)
    if not len(lengths):
        return []
    counts = np.array([histogram[int(x)] for x in lengths], np.float64)
    c, t = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(counts * lengths)])
    best = np.full(len(lengths) + 1, np.inf)
    best[0] = 0
    came = []
    for _ in range(min(buckets, len(lengths))):
        new, source = np.full(len(lengths) + 1, np.inf), np.zeros(len(lengths) + 1, np.int64)
        for j in range(1, len(lengths) + 1):        # pieces i..j-1 are padded to lengths[j-1]
            cost = best[:j] + lengths[j - 1] * (c[j] - c[:j]) - (t[j] - t[:j])
            source[j] = np.argmin(cost)
            new[j] = cost[source[j]]
        best = new
        came.append(source)
    cuts, j = [], len(lengths)
    for source in reversed(came):
        cuts.append(int(lengths[j - 1]))
        j = int(source[j])
        if j == 0:
            break
    return cuts[::-1]


def pieces_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", context: int = CONTEXT) -> DataFrame:
    """doc_id, piece, start_token, n_tokens of each piece of at most ``context`` tokens."""
    d = pick(docs, doc_id=id_col, text=text_col).select(
        "doc_id", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n"))
    last = F.greatest(F.lit(0), F.expr(f"(n - 1) div {context}"))
    return d.select("doc_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("piece")) \
        .select("doc_id", "piece", (F.col("piece") * context).alias("start_token"),
                F.least(F.lit(context), F.col("n") - F.col("piece") * context).cast("long").alias("n_tokens"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", context: int = CONTEXT, buckets: int = BUCKETS,
         budget: int = BUDGET, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row per piece: doc_id, piece, start_token, n_tokens, bucket_len, batch (in its bucket), row (in its batch), padding."""
    rows = staged(pieces_of(docs, id_col, text_col, context), "pack-pieces")
    length = F.greatest(F.lit(1).cast("long"), "n_tokens")
    histogram = {r[0]: r[1] for r in rows.groupBy(length).count().collect()}          # at most `context` bins
    cuts = best_lengths(histogram, buckets) or [context]
    bucket = F.lit(cuts[-1])
    for cut in reversed(cuts[:-1]):
        bucket = F.when(length <= cut, F.lit(cut)).otherwise(bucket)
    slices = max(1, -(-sum(histogram.values()) // slice_rows))
    rows = rows.withColumn("bucket_len", bucket.cast("long")) \
        .withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(slices)))
    counts = rows.groupBy("bucket_len", "slice").count()
    before = Window.partitionBy("bucket_len").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket_len", "slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("bucket_len", "slice").orderBy("doc_id", "piece", "n_tokens")) - 1
    per_batch = F.expr(f"greatest(1, {budget} div bucket_len)")
    return rows.join(offsets, ["bucket_len", "slice"]).withColumn("rank", F.col("before") + rank) \
        .withColumn("per", per_batch).select(
            "doc_id", "piece", "start_token", "n_tokens", "bucket_len", F.expr("rank div per").alias("batch"),
            F.expr("rank % per").alias("row"), (F.col("bucket_len") - F.col("n_tokens")).alias("padding"))
