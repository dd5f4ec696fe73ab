"""Join helpers: checked broadcasts, as-of (validity interval) lookups, and the check of such intervals.

As-of joins (J1, J2, J4) use validity intervals ``[start, end]`` inclusive on
both ends; a NULL end never matches.  Three shapes:

* ``asof_filter`` -- a single "as of date D" filter; Catalyst pushes it into
  the scan, the dimension shrinks before any join.
* ``daily_rows`` -- for set-based jobs over a window of days, clip each
  interval to the window and explode it into one row per day.  The lookup is
  then a pure equi-join on ``(key, day)``: no range residual, no fan-in scan,
  and the exploded size is bounded by ``versions x days in window``.
* ``blocks`` -- without a window, cut each interval into aligned blocks of
  1, 16, 256, 4096 and 65536 days, at most 30 of each size.  A day lies in one
  block of each size and in at most one of an interval's blocks, so "which
  intervals hold this day" is an equi-join on ``(key, size, block)``.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20
TASK_ROWS = 4_000_000      # of an as-of join's result, a task
GRAINS = (1, 16, 256, 4096, 65536)


def bounded_broadcast(df: DataFrame, grows: int | None = None) -> DataFrame:
    """Broadcast a dimension if Spark's own size estimate of it allows that; else leave the join to Spark.

    The estimate comes from the sizes of the files a plan reads, so nothing is counted and no job runs.
    ``grows`` is the factor by which a generator in the plan (one row a day) may multiply the rows, which
    the estimate does not know: by default a year's days where there is one.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    if grows is None:
        grows = 366 if "Generate " in plan.toString() else 1
    size = int(str(plan.stats().sizeInBytes()))
    return F.broadcast(df) if size * grows <= BROADCAST_BYTES else df


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, (dt.date, dt.datetime)):
        return F.lit(x)
    return F.col(x)


def asof_filter(df: DataFrame, on, start: str, end: str) -> DataFrame:
    """Rows valid on ``on``: ``on BETWEEN start AND end``."""
    return df.filter(_c(on).between(F.col(start), F.col(end)))


def daily_rows(df: DataFrame, start: str, end: str, lo: dt.date, hi: dt.date, day: str = "day") -> DataFrame:
    """Explode every interval overlapping ``[lo, hi]`` into one row per covered day."""
    s, e = F.col(start), F.col(end)
    clipped = df.filter((s <= F.lit(hi)) & (e >= F.lit(lo)))
    days = F.sequence(F.greatest(s, F.lit(lo)), F.least(e, F.lit(hi)))
    return clipped.withColumn(day, F.explode(days))


def blocks(df: DataFrame, start: str, end: str, grain: str = "_grain", block: str = "_block") -> DataFrame:
    """Cut every interval into aligned blocks (see module doc): one row a block, without the interval's two columns."""
    a, z = F.unix_date(F.col(start)).cast("long"), F.unix_date(F.col(end)).cast("long") + 1      # half-open, in days
    empty = F.array().cast("array<long>")
    run = lambda lo, hi: F.when(hi > lo, F.sequence(lo, hi - 1)).otherwise(empty)
    found = []
    rows = df.where(F.col(start) <= F.col(end)).withColumns({"_a": a, "_z": z})
    for i, days in enumerate(GRAINS):
        lo, hi = F.col("_a"), F.col("_z")
        if i == len(GRAINS) - 1:
            here, nxt = run(lo, hi), None
        else:                                             # the ragged edges stay at this size, the whole blocks between go on
            up, down = F.ceil(lo / 16) * 16, F.floor(hi / 16) * 16
            through = up >= down
            here = F.when(through, run(lo, hi)).otherwise(F.concat(run(lo, up), run(down, hi)))
            nxt = {"_a": F.when(through, F.lit(0)).otherwise(up / 16).cast("long"), "_z": F.when(through, F.lit(0)).otherwise(down / 16).cast("long")}
        rows = rows.withColumn(f"_b{i}", F.transform(here, lambda b: F.struct(F.lit(days).alias(grain), b.alias(block))))  # noqa: B023
        found.append(f"_b{i}")
        rows = rows.withColumns(nxt) if nxt else rows
    keep = [c for c in df.columns if c not in (start, end)]
    return rows.select(*keep, F.inline(F.concat(*found)))


def _day_blocks(df: DataFrame, day: str, grain: str = "_grain", block: str = "_block") -> DataFrame:
    """Every row once for each block size, with the block that its day lies in."""
    at = F.unix_date(F.col(day)).cast("long")
    return df.select("*", F.inline(F.array(*[F.struct(F.lit(g).alias(grain), F.floor(at / g).cast("long").alias(block)) for g in GRAINS])))


def asof_join(left: DataFrame, right: DataFrame, key: str, day: str, start: str, end: str, how: str = "left",
              window: tuple[dt.date, dt.date] | None = None, salts: int = 1) -> DataFrame:
    """``left`` joined to the ``right`` version valid on ``left[day]`` (J2): ``start <= day <= end``.

    With a known ``window`` of left days the right intervals become one row
    per (key, day) inside the window and the join is a pure equi-join.
    Without a window the distinct (key, day) pairs of the left side (partial
    sums map-side, so a hot key costs its days) meet the intervals' blocks in
    an equi-join, and the left side joins the answers on (key, day): neither
    join has a range residual, and a key's rows are dealt by day.  ``salts``
    deals the rows of one (key, day) over that many tasks; with more than one
    the pairs' answers are counted first, from counts of the blocks, and both
    joins get as many tasks, and the second as many salts, as keep a task near
    ``TASK_ROWS`` rows, which adaptive execution cannot foresee from its inputs.
    ``start``/``end`` of ``right`` are dropped from the result.
    """
    rcols = [c for c in right.columns if c not in (key, start, end)]
    at = [key, "_grain", "_block"]
    if window is not None:
        lo, hi = window
        found = daily_rows(right, start, end, lo, hi, day).select(key, day, *rcols)
    else:
        asked = _day_blocks(left.where(F.col(key).isNotNull() & F.col(day).isNotNull()).select(key, day).distinct(), day)
        cut = blocks(right.select(key, start, end, *rcols), start, end)
        found = asked.join(cut, at).select(key, day, *rcols)
    if salts == 1:
        return left.join(found, [key, day], how)
    n = left.groupBy(key, day).agg(F.count(F.lit(1)).alias("_n"))
    if window is not None:
        counted = n.join(found.groupBy(key, day).agg(F.count(F.lit(1)).alias("_m")), [key, day], "left")
    else:
        held = cut.groupBy(*at).agg(F.count(F.lit(1)).alias("_m"))
        counted = _day_blocks(n, day).join(held.hint("merge"), at, "left").groupBy(key, day).agg(F.max("_n").alias("_n"), F.sum("_m").alias("_m"))
    tasks, finders, salts = _dealing(counted, salts)
    if window is None and finders > 1:                    # the estimate of the blocks is that of the intervals: not to be broadcast
        found = asked.repartition(finders, *at).join(cut.repartition(finders, *at).hint("merge"), at).select(key, day, *rcols)
    salted = left.withColumn("_salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts)))
    spread = found.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    if tasks > 1:
        salted, spread = (df.repartition(tasks, key, day, "_salt") for df in (salted, spread))
    return salted.join(spread, [key, day, "_salt"], how).drop("_salt")


def _dealing(counted: DataFrame, salts: int) -> tuple[int, int, int]:
    """Tasks of the join on (key, day), tasks that find its answers and salts, by which a task makes about ``TASK_ROWS`` rows.

    ``counted`` has a row a (key, day): ``_n`` rows on the left, which remain without an answer, and ``_m`` answers or NULL.
    """
    n, m = F.col("_n").cast("double"), F.coalesce("_m", F.lit(0)).cast("double")
    made = n * F.greatest(m, F.lit(1.0))
    total, answers, widest = (x or 0 for x in counted.agg(F.sum(made), F.sum(m), F.max(F.least(made / TASK_ROWS, n))).first())
    salts = max(salts, math.ceil(widest))
    return math.ceil(total / TASK_ROWS), math.ceil(answers * salts / TASK_ROWS), salts


def interval_conflicts(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """Where a key's validity intervals are no clean sequence: key, kind, day, n.

    ``reversed``: an interval that ends before it starts (day: its start); ``open``: one without start or end (day: the
    other one); ``overlap``: a start day that n > 1 intervals hold; ``gap``: the day after an interval that no interval holds although
    a later one follows.  The days asked about meet the intervals' blocks in an equi-join, so no key is sorted or swept in
    one task; intervals that are reversed or open hold no day.
    """
    s, e = F.col(start), F.col(end)
    rows = df.select(F.col(key).alias("k"), s.alias("s"), e.alias("e"))
    odd = rows.where("s IS NULL OR e IS NULL OR e < s").select(
        "k", F.when(F.col("e") < F.col("s"), "reversed").otherwise("open").alias("kind"), F.coalesce("s", "e").alias("day"), F.lit(1).cast("long").alias("n"))
    good = rows.where("s <= e")
    last = good.groupBy("k").agg(F.max("e").alias("last"))
    ends = good.join(last, "k").where("e < last").select("k", F.date_add("e", 1).alias("day"), F.lit("gap").alias("kind"))
    asked = good.select("k", F.col("s").alias("day"), F.lit("overlap").alias("kind")).unionByName(ends).distinct()
    held = _day_blocks(asked, "day").join(blocks(good, "s", "e"), ["k", "_grain", "_block"]).groupBy("k", "day", "kind").agg(F.count(F.lit(1)).alias("n"))
    overlap = held.where("kind = 'overlap' AND n > 1")
    gaps = asked.where("kind = 'gap'").join(held.where("kind = 'gap'").select("k", "day"), ["k", "day"], "left_anti").withColumn("n", F.lit(0).cast("long"))
    cols = [F.col("k").alias(key), "kind", "day", "n"]
    return odd.select(*cols).unionByName(overlap.select(*cols)).unionByName(gaps.select(*cols))
