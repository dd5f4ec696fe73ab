"""Run log (L9) and load report.

The log is append-only parquet.  A message longer than 4000 characters is
stored as several rows (F17; a message is one driver-side string, so it is
split in Python -- ``operators.chunks.split_chunks`` splits whole texts held
in a table); an empty or NULL message stores nothing.  The
database session columns of the reference (pid, user, client address) are
replaced by the Spark application id and user.  The run id is passed in by
the caller (F16) rather than read back from a shared sequence (Q10), and the
clock can be injected for tests (F14).  A run claims its id with a marker file
that only one run can create, so runs that start together get different ids.
"""

from __future__ import annotations

import datetime as dt
import itertools
import threading
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.chunks import LOG_PIECE
from ledgerlake.schemas import LOG_INFO
from ledgerlake.sinks import fs
from ledgerlake.sinks.store import AppendLog
from ledgerlake.sources.local import rows_frame

# Fixed value: the reference forces every message to type 1 (notice).
NOTICE = 1

_COUNT = itertools.count()


def next_run_id(log: DataFrame) -> int:
    """F16: one more than the largest run id logged so far (taken once, at run start)."""
    r = log.agg(F.max("pipeline_run_id").alias("m")).first()
    return (r.m or 0) + 1


def claim_run_id(spark: SparkSession, log_path: str) -> int:
    """F16: a run id that no other run of this log has: the first free one after the largest logged or claimed.

    Claims are empty marker files in ``_runs`` beside the log's data, which readers of the log pass over.
    """
    folder = f"{log_path.rstrip('/')}/_runs"
    claimed = max((int(n) for n in fs.list_names(spark, folder) if n.isdigit()), default=0)
    run_id = max(next_run_id(AppendLog(spark, log_path, LOG_INFO).read()), claimed + 1)
    while not fs.create_new(spark, f"{folder}/{run_id}"):
        run_id += 1
    return run_id


def pieces(message: str | None, size: int = LOG_PIECE) -> list[str]:
    """F17 for one driver-side message: 4000-character pieces; empty or NULL gives none."""
    return [message[i:i + size] for i in range(0, len(message), size)] if message else []


def log_rows(spark: SparkSession, message: str | None, run_id: int | None, event_type: str | None,
             rows_affected: int | None = None, info: str | None = None, clock=dt.datetime.now) -> DataFrame:
    """The log rows of one message: one row per 4000-character piece, type forced to notice."""
    now = clock()
    sc = spark.sparkContext
    base = int(now.timestamp() * 1e6) * 4096           # the clock, then a count: no two messages share an id
    rows = [(base + next(_COUNT) % 4096, run_id, now, event_type, piece, rows_affected, NOTICE, sc.applicationId, sc.sparkUser(), info)
            for piece in pieces(message)]
    return rows_frame(spark, rows, LOG_INFO)


def write_log(spark: SparkSession, log_path: str, message: str | None, run_id: int | None = None,
              event_type: str | None = None, rows_affected: int | None = None, info: str | None = None,
              clock=dt.datetime.now) -> None:
    """``write_log_info``; without run id and event it is the plain message log (``writelog``)."""
    rows = log_rows(spark, message, run_id, event_type, rows_affected, info, clock=clock)
    if message:                                       # a handful of rows: one small file per message
        AppendLog(spark, log_path, LOG_INFO).append(rows.coalesce(1))


class RunLogger:
    """Messages of one run; a step's messages are appended together when it ends, also when it fails."""

    def __init__(self, spark: SparkSession, log_path: str, clock=dt.datetime.now, run_id: int | None = None):
        self.spark, self.clock, self.held, self.lock = spark, clock, [], threading.Lock()
        self.log = AppendLog(spark, log_path, LOG_INFO)
        self.run_id = claim_run_id(spark, log_path) if run_id is None else run_id

    def message(self, text: str, event: str, rows: int | None = None, info: str | None = None) -> DataFrame:
        """The rows of a message, held until the next ``flush``."""
        out = log_rows(self.spark, text, self.run_id, event, rows, info, clock=self.clock)
        with self.lock:
            self.held.append(out)
        return out

    def flush(self) -> None:
        with self.lock:                                   # steps may run side by side; one append to the log at a time
            out = None
            for rows in self.held:
                out = rows if out is None else out.unionByName(rows)
            self.held = []
            if out is not None:
                self.log.append(out.coalesce(1))          # a handful of rows: one small file per step

    def finished(self, name: str, event: str, inputs: str) -> bool:
        """Whether the last logged END of this step, of whichever run, had the same inputs."""
        ended = self.log.read().where((F.col("event_type") == event) & (F.col("message_") == f"[END] {name}"))
        last = ended.agg(F.max_by("info_", F.struct("date_time", "record_id")).alias("info")).first()
        return last is not None and last["info"] is not None and last["info"] == inputs

    @contextmanager
    def step(self, name: str, event: str, inputs: str | None = None):
        """Logs BEGIN, then END with the rows the step set in ``affected["rows"]`` and its inputs (or FAILED with the error)."""
        self.message(f"[BEGIN] {name}", event)
        affected: dict = {}
        try:
            yield affected
            self.message(f"[END] {name}", event, affected.get("rows"), inputs)
        except Exception as error:
            self.message(f"[FAILED] {name}: {str(error)[:1000]}", event)
            raise
        finally:
            self.flush()


LOAD_EVENTS_DDL = "load_id bigint, event string, event_time timestamp"


def load_event(spark: SparkSession, path: str, load_id: int, event: str, clock=dt.datetime.now) -> None:
    """W6 without UPDATE: a load's start and finish are two appended events."""
    row = rows_frame(spark, [(load_id, event, clock())], LOAD_EVENTS_DDL)
    row.write.mode("append").parquet(path)


def load_runs(events: DataFrame) -> DataFrame:
    """``log_loading`` as read: one row per load, started_at = first 'start', finished_at = last 'finish'."""
    ev = F.col("event")
    at = F.col("event_time")
    return events.groupBy("load_id").agg(F.min(F.when(ev == "start", at)).alias("started_at"),
                                          F.max(F.when(ev == "finish", at)).alias("finished_at"))


def load_report(loads: DataFrame, table_events: DataFrame) -> DataFrame:
    """Every load with its table events (left join on load_id) and the seconds since the load started."""
    j = loads.join(table_events, "load_id", "left")
    dur = F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("event_time"))   # wall-clock, zone-free
    return j.select("load_id", "started_at", "finished_at", "event_time", "source_table", "event_type",
                    "rows_affected", (dur / F.lit(1_000_000)).alias("load_duration_sec"))
