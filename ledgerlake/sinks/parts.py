"""Tables of parts with a manifest: a write rewrites only what it touches and is one atomic switch.

A table is a folder with data folders and manifests ``manifest-000001.json``,
``manifest-000002.json``...  A part is a value of a partition expression (a
day, or a bucket of a key's hash) and consists of segments, folders written at
different times.  The manifest names the segments of every part with their
rows, bytes and schema, the schemas so far, and a few notes (which sessions or
stream epochs the table contains).  A writer writes new folders and then the
next manifest, written aside and renamed into place: readers see the table
before or after the write, never a mix, and a killed write leaves only folders
no manifest names.  One writer at a time is assumed, any number of readers.

* **Buckets that grow.**  The buckets of a key's hash are a directory of bit
  strings, as in extendible hashing: a bucket holds the keys whose hash ends in
  its bits.  A write that would bring a bucket over ``split_rows`` or
  ``split_bytes`` splits that bucket, and no other, as often as needed.
* **Skipping.**  ``merge`` rewrites a segment only if it holds a key of the
  batch; rows of new keys are appended to their part as one more segment.  A
  segment's key hashes are kept as bitmaps beside the data (built-in bitmap
  aggregates); segments that pass them are looked up by their key columns, so
  the answer is exact.  More than ``MAX_SEGMENTS`` segments are merged into one.
* **Schema history.**  A segment is read with the schema it was written with
  and its columns are widened to the table's (``sinks.types``).  A narrowing of
  a column that stays stored is refused before anything is written.
"""

from __future__ import annotations

import json
import math
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.sinks import fs
from ledgerlake.sinks.types import as_of_now, refused
from ledgerlake.sources.local import rows_frame

PART = "_part"
SPLIT_ROWS, SPLIT_BYTES = 2_000_000, 256 << 20
MAX_SEGMENTS = 8
MAX_DEPTH = 40                       # bits of the hash that buckets may use
BITMAP_BITS = 32768                  # of one bitmap (Spark's bitmap aggregates)
KEYS_A_BITMAP = 2048                 # 16 bits a key
LISTERS_A_CORE = 4                   # tasks that list folders
_LISTERS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
FILTER_FROM = 200_000                # rows from which bitmaps are made, and asked before the key columns


def key_bucket(keys: list[str], buckets: int) -> Column:
    """Bucket of a key's hash, a fixed number of them; NULL keys have a bucket too."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets))


# ---------------------------------------------------------------- the directory of buckets
def directory_of(buckets: int) -> list[str]:
    """The buckets of an empty table: at least ``buckets``, a power of two."""
    depth = max(0, math.ceil(math.log2(max(1, buckets))))
    return ["b" + format(i, f"0{depth}b")[::-1] if depth else "b" for i in range(1 << depth)]


def bucket_in(h: Column, directory: list[str]) -> Column:
    """The bucket of a key hash: the one whose bits are the hash's last ones, the lowest bit first."""
    bits = F.reverse(F.lpad(F.conv(F.hex(h.bitwiseAND(F.lit((1 << MAX_DEPTH) - 1))), 16, 2), MAX_DEPTH, "0"))
    depths = sorted({len(b) for b in directory})
    found = None
    for depth in reversed(depths):
        name = F.concat(F.lit("b"), F.substring(bits, 1, depth - 1))
        if found is not None:                             # a bucket of this depth, or one that was split: the shorter list tells
            own, gone = {b for b in directory if len(b) == depth}, {b[:depth] for b in directory if len(b) > depth}
            name = F.when(name.isin(sorted(own)), name).otherwise(found) if len(own) <= len(gone) else F.when(name.isin(sorted(gone)), found).otherwise(name)
        found = name
    return found


@dataclass
class _Listing:
    lock: threading.Lock = field(default_factory=threading.Lock)
    open: int = 0
    old: str = ""


_listing = _Listing()


@dataclass
class Merged:
    """What a ``merge`` did: rows written (new and rewritten), segments rewritten and left as they were, in parts touched and in all."""
    version: int
    rows_written: int
    parts_touched: int
    segments_rewritten: int
    segments_kept: int
    buckets_split: int


@dataclass
class _Manifest:
    parts: dict[str, list[dict]] = field(default_factory=dict)
    schemas: list[dict] = field(default_factory=list)
    notes: dict = field(default_factory=dict)
    directory: list[str] | None = None

    def schema(self) -> T.StructType | None:
        return T.StructType.fromJson(self.schemas[-1]) if self.schemas else None

    def with_schema(self, schema: T.StructType) -> int:
        """The number of ``schema``, which becomes the table's."""
        if not self.schemas or self.schemas[-1] != schema.jsonValue():
            self.schemas = [*self.schemas, schema.jsonValue()]
        return len(self.schemas) - 1


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


class PartsTable:
    def __init__(self, spark: SparkSession, base: str, schema: T.StructType | None = None,
                 split_rows: int = SPLIT_ROWS, split_bytes: int = SPLIT_BYTES):
        self.spark, self.base, self.declared = spark, base.rstrip("/"), schema
        self.split_rows, self.split_bytes = split_rows, split_bytes

    # -- manifests
    def _path(self, number: int) -> str:
        return f"{self.base}/manifest-{number:06d}.json"

    def numbers(self) -> list[int]:
        names = (n[9:-5] for n in fs.list_names(self.spark, self.base) if n.startswith("manifest-") and n.endswith(".json"))
        return sorted(int(n) for n in names if n.isdigit())

    def current(self) -> int | None:
        return max(self.numbers(), default=None)

    def exists(self) -> bool:
        return self.current() is not None

    def _manifest(self, number: int | None = None) -> _Manifest:
        number = self.current() if number is None else number
        return _Manifest(**json.loads(fs.read_text(self.spark, self._path(number)))) if number else _Manifest()

    def _switch(self, m: _Manifest) -> int:
        number = (self.current() or 0) + 1
        fs.write_text(self.spark, self._path(number), json.dumps(vars(m)))
        return number

    def notes(self) -> dict:
        return self._manifest().notes

    def parts(self, number: int | None = None) -> dict[str, list[str]]:
        """Part value -> its segments' folders, as of the newest (or a given) manifest."""
        return {p: [s["folder"] for s in segs] for p, segs in self._manifest(number).parts.items()}

    def changed_parts(self, since: int) -> list[str]:
        """The change feed between manifest ``since`` and the newest: parts whose segments differ (added, rewritten or gone)."""
        old, new = self.parts(since), self.parts()
        return sorted(p for p in set(old) | set(new) if old.get(p) != new.get(p))

    def sizes(self) -> dict[str, tuple[int, int]]:
        """Part value -> rows and bytes."""
        return {p: (sum(s["rows"] or 0 for s in segs), sum(s["bytes"] for s in segs)) for p, segs in self._manifest().parts.items()}

    def schema(self) -> T.StructType | None:
        return self._manifest().schema() or self.declared

    # -- reading
    def read(self, parts: Iterable[str] | None = None) -> DataFrame:
        """The whole table, or the given parts only, with the table's types of today."""
        return self._read(self._manifest(), None if parts is None else set(parts))

    def read_version(self, number: int) -> DataFrame:
        """The table as an older manifest has it, as long as it is not pruned."""
        return self._read(self._manifest(number), None)

    def _read(self, m: _Manifest, parts: set[str] | None) -> DataFrame:
        schema = m.schema() or self.declared
        if schema is None:
            raise FileNotFoundError(f"no manifest under {self.base}")
        return self._read_segments(m, [s for p, segs in sorted(m.parts.items()) if parts is None or p in parts for s in segs], _nullable(schema))

    def _read_segments(self, m: _Manifest, segments: list[dict], schema: T.StructType) -> DataFrame:
        frames = []
        for number in sorted({s["schema"] for s in segments}):
            old = T.StructType.fromJson(m.schemas[number])
            rows = self._files(old, [s["folder"] for s in segments if s["schema"] == number])
            frames.append(rows if old == schema else rows.select(*as_of_now(old, schema)))
        return reduce(DataFrame.unionByName, frames) if frames else rows_frame(self.spark, [], schema)

    def _files(self, schema: T.StructType, folders: list[str]) -> DataFrame:
        with self._few_listers():
            return self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*[f"{self.base}/{f}" for f in folders])

    @contextmanager
    def _few_listers(self) -> Iterator[None]:
        """Within the block Spark lists many folders in a few tasks a core, not in a task each."""
        conf = self.spark.conf
        with _listing.lock:                               # loads side by side share the setting: the last one restores it
            if not _listing.open:
                _listing.old = conf.get(_LISTERS)
                conf.set(_LISTERS, str(min(int(_listing.old), LISTERS_A_CORE * self.spark.sparkContext.defaultParallelism)))
            _listing.open += 1
        try:
            yield
        finally:
            with _listing.lock:
                _listing.open -= 1
                if not _listing.open:
                    conf.set(_LISTERS, _listing.old)

    # -- writing
    def replace(self, rows: DataFrame, part: Column, touched: Iterable[str] | None = None, notes: dict | None = None,
                schema: T.StructType | None = None, directory: list[str] | None = None) -> int:
        """Put ``rows`` in place of the parts ``touched`` (None: of the whole table); returns the manifest's number.

        Rows that belong to another part are an error and nothing is switched.  A touched part without rows ends empty.
        """
        m = self._manifest()
        schema = _nullable(schema or m.schema() or self.declared or rows.schema)
        allowed = None if touched is None else sorted({str(t) for t in touched})
        kept = {} if allowed is None else {p: s for p, s in m.parts.items() if p not in set(allowed)}
        self._check_widening(m, kept, schema)
        new = self._write(rows, part, allowed, schema)
        m.directory = directory if directory is not None else m.directory if allowed is not None else None
        number = m.with_schema(schema)
        m.parts = kept | {p: [s | {"schema": number}] for p, s in new.items()}
        m.notes = m.notes | (notes or {})
        return self._switch(m)

    def merge(self, batch: DataFrame, keys: list[str], combine: Callable[[DataFrame, DataFrame], DataFrame], part: Column | None = None,
              notes: dict | None = None, schema: T.StructType | None = None, buckets: int = 1) -> Merged:
        """Bring ``batch`` into a keyed table: ``combine(old, batch)`` gives the rows of the segments that hold a key of the batch,
        with the batch's.  Rows of one key must lie in one part: ``part``, or (None) a bucket of the directory.

        ``batch`` is read several times; callers stage it.  An empty table starts with ``buckets`` buckets.
        """
        m = self._manifest()
        schema = _nullable(schema or m.schema() or self.declared)
        kinds = {f.name: f.dataType for f in schema.fields}
        h = F.xxhash64(*[F.col(k).cast(kinds[k]) for k in keys])
        old = m.schema()
        moved = old is not None and any(f.name in keys and f.dataType != kinds.get(f.name) for f in old.fields)
        if part is None and (moved or m.directory is None):           # other hashes, or other parts: everything is dealt anew
            moved = moved or bool(m.parts)
            m.directory = m.directory or directory_of(buckets)
        old_part = (lambda: part) if part is not None else (lambda: bucket_in(h, m.directory))
        counts = {r[0]: r["count"] for r in batch.groupBy(old_part().cast("string").alias(PART)).count().collect()}
        stored = {p: sum(s["rows"] or 0 for s in segs) for p, segs in m.parts.items()}
        split = {} if part is not None or moved else self._splits(m, counts, stored)
        touched = set(m.parts) | set(counts) if moved else set(counts)
        whole = {p for p in touched if moved or p in split or len(m.parts.get(p, [])) >= MAX_SEGMENTS}
        hit = {s["folder"] for p in whole for s in m.parts.get(p, [])}
        maybe = {p: m.parts[p] for p in touched - whole if p in m.parts}
        hit |= self._holding(m, maybe, batch.select(old_part().cast("string").alias("part"), h.alias("h")), h, keys)
        if split:
            m.directory = sorted(set(m.directory) - set(split) | {c for kids in split.values() for c in kids})
        self._check_widening(m, {p: [s for s in segs if s["folder"] not in hit] for p, segs in m.parts.items()}, schema)
        expected = {}
        for p in touched:
            n = counts.get(p, 0) + sum(s["rows"] or 0 for s in m.parts.get(p, []) if s["folder"] in hit)
            for kid in split.get(p, [p]):
                expected[kid] = max(1, -(-n // len(split.get(p, [p]))))
        old_rows = self._read_segments(m, [s for segs in m.parts.values() for s in segs if s["folder"] in hit], schema)
        new_part = part if part is not None else bucket_in(h, m.directory)
        new = self._write(combine(old_rows, batch), new_part, None if moved else sorted(expected), schema, (h, expected))
        number = m.with_schema(schema)
        total = sum(len(segs) for segs in m.parts.values())
        parts = {p: [s for s in segs if s["folder"] not in hit] for p, segs in m.parts.items()}
        for p, s in new.items():
            parts[p] = [*parts.get(p, []), s | {"schema": number}]
        m.parts = {p: segs for p, segs in parts.items() if segs}
        m.notes = m.notes | (notes or {})
        return Merged(self._switch(m), self.rows_written, len(touched), len(hit), total - len(hit), len(split))

    def _check_widening(self, m: _Manifest, kept: dict[str, list[dict]], schema: T.StructType) -> None:
        numbers = {s["schema"] for segs in kept.values() for s in segs}
        for number in sorted(numbers | ({len(m.schemas) - 1} if numbers else set())):     # what is stored, and what readers see today
            bad = refused(T.StructType.fromJson(m.schemas[number]), schema)
            if bad:
                raise ValueError(f"{self.base}: stored rows do not fit a narrower type ({', '.join(bad)})")

    def _splits(self, m: _Manifest, counts: dict[str, int], stored: dict[str, int]) -> dict[str, list[str]]:
        """Buckets that the batch would bring over the limits -> the buckets that take their place."""
        known = [s for segs in m.parts.values() for s in segs if s["rows"]]
        width = sum(s["bytes"] for s in known) / max(1, sum(s["rows"] for s in known))         # bytes a row, as far as rows are counted
        out = {}
        for p, n in counts.items():
            size = sum(s["bytes"] for s in m.parts.get(p, [])) + n * width
            over = max((n + stored.get(p, 0)) / self.split_rows, size / self.split_bytes)
            levels = min(math.ceil(math.log2(over)) if over > 1 else 0, MAX_DEPTH + 1 - len(p))
            if levels > 0:
                out[p] = [p + format(i, f"0{levels}b") for i in range(1 << levels)]
        return out

    def _write(self, rows: DataFrame, part: Column, allowed: list[str] | None, schema: T.StructType,
               hashed: tuple[Column, dict[str, int]] | None = None) -> dict[str, dict]:
        """New folders of the parts of ``rows``; with the key hash and the expected rows by part also their bitmaps."""
        name = uuid.uuid4().hex
        folder = f"data/{name}"
        typed = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields]).withColumn(PART, part.cast("string"))
        stray = F.lit(False) if allowed is None else ~F.coalesce(F.col(PART).isin(allowed), F.lit(False)) if allowed else F.lit(True)
        seen = Observation(f"stray_{uuid.uuid4().hex[:8]}")
        (typed.observe(seen, F.count(F.when(stray, 1)).alias("stray"), F.count(F.lit(1)).alias("rows"))
         .hint("rebalance", PART).write.partitionBy(PART).parquet(f"{self.base}/{folder}"))
        found = fs.list_dirs(self.spark, f"{self.base}/{folder}")
        facts = seen.get if found else {"stray": 0, "rows": 0}       # a plan that Spark knows to be empty observes nothing
        if facts["stray"]:
            raise ValueError(f"{facts['stray']} rows lie outside the parts to be replaced ({', '.join((allowed or ['none'])[:3])}..)")
        self.rows_written = int(facts["rows"])
        new = {n[len(PART) + 1:]: f"{folder}/{n}" for n in found if n.startswith(f"{PART}=")}
        if not new:
            return {}
        written = self._files(schema, [folder])                       # listed once
        groups = self._bitmaps(written, name, new, *hashed) if hashed and sum(hashed[1].values()) >= FILTER_FROM else {}
        sizes = self._sizes(written)
        return {p: {"folder": f, "rows": sizes[f][0], "bytes": sizes[f][1], "groups": groups.get(p)} for p, f in new.items()}

    def _sizes(self, written: DataFrame) -> dict[str, tuple[int, int]]:
        """Rows and bytes of every segment in a folder just written, from the files' footers."""
        files = written.groupBy("_metadata.file_path", "_metadata.file_size").count()
        return {r["folder"]: (r["n"], r["bytes"]) for r in files.groupBy(self._folder(F.col("file_path")).alias("folder")).agg(
            F.sum("count").alias("n"), F.sum("file_size").alias("bytes")).collect()}

    # -- skipping
    def _bitmaps(self, written: DataFrame, name: str, found: dict[str, str], h: Column, expected: dict[str, int]) -> dict[str, int]:
        """Bitmaps of the key hashes of every part just written, as a table beside the data; their number by part."""
        groups = {p: 1 << max(0, math.ceil(math.log2(expected.get(p, 1) / KEYS_A_BITMAP))) if expected.get(p, 1) > KEYS_A_BITMAP else 1 for p in found}
        wanted = rows_frame(self.spark, [(p, f, groups[p]) for p, f in found.items()], "part string, folder string, groups long")
        rows = written.select(self._folder().alias("folder"), h.alias("h"))
        at = F.pmod("h", F.col("groups") * BITMAP_BITS)
        bitmaps = rows.join(F.broadcast(wanted), "folder").withColumn("at", at).groupBy("part", "folder", F.expr(f"at div {BITMAP_BITS}").alias("grp")).agg(
            F.bitmap_construct_agg(F.col("at") % BITMAP_BITS).alias("bitmap"))
        bitmaps.write.parquet(f"{self.base}/filters/{name}")
        return groups

    def _folder(self, path: Column | None = None) -> Column:
        """The segment (``data/<write>/_part=<value>``) of a row's file."""
        return F.concat(F.lit("data/"), F.regexp_extract(F.col("_metadata.file_path") if path is None else path, rf"/data/([0-9a-f]{{32}}/{PART}=[^/]*)/", 1))

    def _holding(self, m: _Manifest, parts: dict[str, list[dict]], hashes: DataFrame, h: Column, keys: list[str]) -> set[str]:
        """Folders of the segments in ``parts`` that hold a key of ``hashes`` (part, h)."""
        segments = [(p, s) for p, segs in parts.items() for s in segs]
        if not segments:
            return set()
        asked = hashes.distinct()
        filtered = [(p, s["folder"], s["groups"]) for p, s in segments if s["groups"]]
        if filtered and sum(s["rows"] or 0 for _, s in segments) >= FILTER_FROM:
            known = rows_frame(self.spark, filtered, "part string, folder string, groups long")
            names = sorted({f.split("/")[1] for _, f, _ in filtered})
            bitmaps = self.spark.read.parquet(*[f"{self.base}/filters/{n}" for n in names]).select("folder", "grp", "bitmap")
            at = asked.join(F.broadcast(known), "part").withColumn("at", F.pmod("h", F.col("groups") * BITMAP_BITS)) \
                .select("folder", F.expr(f"at div {BITMAP_BITS}").alias("grp"), (F.col("at") % BITMAP_BITS).cast("int").alias("at"))
            byte = F.conv(F.hex(F.substring(F.col("bitmap"), F.expr("cast(at div 8 as int)") + 1, F.lit(1))), 16, 10).cast("int")
            is_set = F.call_function("shiftright", byte, F.col("at") % 8).bitwiseAND(F.lit(1)) == 1
            passed = {r[0] for r in at.join(bitmaps, ["folder", "grp"]).where(is_set).select("folder").distinct().collect()}
            segments = [(p, s) for p, s in segments if s["folder"] in passed or not s["groups"]]
        out: set[str] = set()
        for number in sorted({s["schema"] for _, s in segments}):
            old = T.StructType.fromJson(m.schemas[number])
            rows = self._files(old, [s["folder"] for _, s in segments if s["schema"] == number]).select(self._folder().alias("folder"), h.alias("h"))
            out |= {r[0] for r in rows.join(asked.select("h").distinct(), "h", "left_semi").select("folder").distinct().collect()}
        return out

    # -- upkeep
    def prune(self, keep: int = 2) -> list[int]:
        """Remove manifests older than the newest ``keep`` and the folders only they (or dead writes) name."""
        if keep < 1:
            raise ValueError("keep must be at least 1")
        numbers = self.numbers()
        gone = numbers[:-keep]
        if not gone:
            return []
        live = {f for n in numbers[-keep:] for folders in self.parts(n).values() for f in folders}
        for n in gone:
            fs.delete(self.spark, self._path(n))
        for d in fs.list_dirs(self.spark, f"{self.base}/data"):
            dirs = [f"data/{d}/{p}" for p in fs.list_dirs(self.spark, f"{self.base}/data/{d}")]
            if not any(p in live for p in dirs):
                fs.delete(self.spark, f"{self.base}/data/{d}")
                fs.delete(self.spark, f"{self.base}/filters/{d}")
            else:
                for p in dirs:
                    if p not in live and p.split("/")[-1].startswith(PART):
                        fs.delete(self.spark, f"{self.base}/{p}")
        return gone
