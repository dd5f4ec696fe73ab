"""Literal rows built JVM-side keep their declared types, NULLs and order-free content."""

import datetime as dt
from decimal import Decimal

from ledgerlake.plans import runlog
from ledgerlake.schemas import LOG_INFO
from ledgerlake.sinks.store import AppendLog
from ledgerlake.sources.local import rows_frame


def test_rows_frame_types_and_nulls(spark):
    schema = "a int, b string, c date, d timestamp, e decimal(10,2)"
    rows = [(1, "x", dt.date(2018, 1, 2), dt.datetime(2018, 1, 2, 3, 4, 5), Decimal("1.50")),
            (None, None, None, None, None)]
    df = rows_frame(spark, rows, schema)
    assert df.schema.simpleString() == "struct<a:int,b:string,c:date,d:timestamp,e:decimal(10,2)>"
    got = sorted([tuple(r) for r in df.collect()], key=repr)
    assert got == sorted(rows, key=repr)


def test_rows_frame_empty_keeps_the_schema(spark):
    df = rows_frame(spark, [], "k bigint, v string")
    assert df.count() == 0 and df.columns == ["k", "v"]


def test_plain_message_log_without_run_id(spark, workdir):
    runlog.write_log(spark, f"{workdir}/lg", "insert", clock=lambda: dt.datetime(2024, 1, 1))
    r = AppendLog(spark, f"{workdir}/lg", LOG_INFO).read().first()
    assert (r.message_, r.pipeline_run_id, r.event_type, r.message_type) == ("insert", None, None, 1)
