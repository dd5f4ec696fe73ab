"""Text exchange, tables of growing parts, schema history, skipping, run ids and sessions."""

import csv
import os
import subprocess
import sys
import tempfile
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators.upsert import upsert
from ledgerlake.plans import exchange, mirror, runlog
from ledgerlake.plans.loader import ConstraintError, load_table
from ledgerlake.schemas import LOG_INFO, TABLES
from ledgerlake.sinks import parts as parts_module
from ledgerlake.sinks.parts import PartsTable, bucket_in, directory_of
from ledgerlake.sinks.store import AppendLog
from ledgerlake.sources import csv_files
from ledgerlake.sources.csv_files import spans_lines
from ledgerlake.streaming import delta_stream

HEADER = "\t;DATA_ACTUAL_DATE;DATA_ACTUAL_END_DATE;CURRENCY_RK;REDUCED_COURCE;CODE_ISO_NUM\n"


def _local(path):
    return path.replace("file:", "")


def _file(workdir, name, text, encoding="cp866"):
    os.makedirs(_local(workdir), exist_ok=True)
    path = f"{_local(workdir)}/{name}"
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)
    return path


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---------------------------------------------------------------- text
@pytest.mark.parametrize("rest", ["", ";2;643;x;y"])
def test_records_of_the_wrong_width_fail_or_are_rejected(spark, workdir, rest):
    f = _file(workdir, "r.csv", HEADER + f"1;2018-01-01;2018-01-31;30;12.5;643\n2;2018-01-01;2018-01-31;31{rest}\n")
    for mode in ("fail", "null"):
        with pytest.raises(ConstraintError):
            load_table(spark, TABLES["md_exchange_rate_d"], f, f"{workdir}/{mode}", bad_values=mode)
        assert not PartsTable(spark, f"{workdir}/{mode}").exists()
    out = load_table(spark, TABLES["md_exchange_rate_d"], f, f"{workdir}/ok", bad_values="reject")
    assert (out.rows_in_file, out.rows_rejected) == (2, 1)
    assert [r.currency_rk for r in PartsTable(spark, f"{workdir}/ok").read().collect()] == [30]
    bad = spark.read.parquet(f"{workdir}/ok_rejects").first()
    assert bad.bad_columns == ["(width)"] and f"2;2018-01-01;2018-01-31;31{rest}" in bad.row_text


@pytest.mark.parametrize("mode", ["fail", "null", "reject"])
def test_a_quoted_line_break_is_one_record_as_in_csv_reader(spark, workdir, mode):
    text = HEADER + '1;2018-01-01;"2018-01-31";30;12.5;"6\n3"\r\n2;2018-01-01;2018-01-31;31;2;"6""3"\n\n3;2018-01-01;2018-01-31;32;2;";"'
    f = _file(workdir, "q.csv", text)
    out = load_table(spark, TABLES["md_exchange_rate_d"], f, f"{workdir}/{mode}", bad_values=mode)
    want = [r[5] for r in csv.reader(text.splitlines(keepends=True), delimiter=";") if r][1:]
    assert out.rows_in_file == 3 and out.rows_rejected == 0
    assert [r.code_iso_num for r in PartsTable(spark, f"{workdir}/{mode}").read().orderBy("currency_rk").collect()] == want


def test_only_lines_with_a_quote_are_taken_apart(spark):
    """The quote scan of a large file asks for a quote before it runs patterns over a line."""
    cases = [("1;2", False), ("", False), (None, None), ('"x";"y;z"', False), ('"1""2";""', False), ('"x', True), ('5" ;"x', True), ('"""";"', True)]
    lines = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, value string")
    got = lines.select("i", csv_files._goes_on(F.col("value"), ";").alias("on")).orderBy("i").collect()
    assert [r["on"] for r in got] == [want for _, want in cases]
    condition = lines.where(csv_files._goes_on(F.col("value"), ";"))._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < condition.find("Contains(value") < condition.find("regexp_replace(")


def test_files_are_split_by_lines_only_where_no_record_goes_on(spark, workdir):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cases = [('a;b\n"x";"y;z"\n"1""2";""\n', False), ('a;b\n"x\ny";1\n', True), ('a;b\n5" ;"x\ny"\n', True), ("a;b\n1;2\n", False), ('a;b\n"""";"\n"\n', True)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        for n, (text, want) in enumerate(cases):
            assert spans_lines(spark, [_file(workdir, f"s{n}.csv", text * 20)]) is want, text
        rows = [(i, 'a "b"; c', " pad ") for i in range(200)]
        df = spark.createDataFrame(rows, "id int, a string, b string")
        path = exchange.export_csv(df, f"{workdir}/split.csv")
        back = exchange.import_csv(spark, path, df.schema)
        assert back.rdd.getNumPartitions() > 4 and _rows(back) == _rows(df)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_export_and_import_keep_every_text(spark, workdir):
    rows = [(1, "two\nlines", "  pad "), (2, "", None), (3, None, ""), (4, 'say "hi"; ok', "\\back\\"), (5, '"', "a;b"), (6, "a\r\nb", "c\rd"),
            (7, " ", "\t"), (8, "'", "NULL"), (9, '""', 'x"y'), (10, "\n", "é—😀"), (11, '\\"', '"\\'), (12, None, None)]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    path = exchange.export_file(df, f"{workdir}/report_2018-01-25.csv")
    with open(_local(path), newline="", encoding="utf-8") as f:
        assert [tuple(r) for r in csv.reader(f, delimiter=";")] == [("id", "a", "b")] + [(str(i), a or "", b or "") for i, a, b in rows]
    assert sorted(tuple(r) for r in exchange.import_csv(spark, path, df.schema).collect()) == rows
    standard = _file(workdir, "copy.csv", 'id;a;b\n1;"say ""hi""; ok";\n2;"";x\n', "utf-8")
    assert _rows(exchange.import_csv(spark, standard, df.schema)) == [(1, 'say "hi"; ok', None), (2, "", "x")]


@pytest.mark.parametrize("line", ["1;x;y;z", "1;x"])
def test_import_refuses_records_of_another_width(spark, workdir, line):
    f = _file(workdir, "bad.csv", f"id;a;b\n{line}\n", "utf-8")
    df = exchange.import_csv(spark, f, T.StructType.fromDDL("id int, a string, b string"))
    for columns in (["id", "a", "b"], ["a"]):
        with pytest.raises(Exception):
            df.select(*columns).collect()


# ---------------------------------------------------------------- buckets that grow
def _last(old, new):
    return upsert(old, new, ["k"], ["v"])


def test_buckets_stay_bounded_over_ten_loads_that_multiply_the_table(spark, workdir):
    t = PartsTable(spark, f"{workdir}/t", T.StructType.fromDDL("k long, v int"), split_rows=500)
    for r in range(10):
        t.merge(spark.range(16 * 2 ** r).select(F.col("id").alias("k"), F.lit(r).alias("v")), ["k"], _last)
        if r >= 7:
            assert max(n for n, _ in t.sizes().values()) <= 1.3 * 500     # a bucket's share of the hashes varies a little
    assert len(t.parts()) >= 8192 // 500 and t.read().count() == 8192
    assert {r.v for r in t.read().select("v").distinct().collect()} == {9}
    buckets = t.read().select(bucket_in(F.xxhash64("k"), sorted(t.parts())).alias("b"), "k")
    assert buckets.where("b IS NULL").isEmpty()


def test_one_hot_bucket_splits_alone(spark, workdir):
    t = PartsTable(spark, f"{workdir}/t", T.StructType.fromDDL("k long, v int"), split_rows=100)
    rows = spark.range(150).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    t.merge(rows, ["k"], _last, buckets=4)
    before = t.parts()
    hot = sorted(before)[0]
    more = spark.range(1000, 3000).select(F.col("id").alias("k"), F.lit(2).alias("v")).where(bucket_in(F.xxhash64("k"), directory_of(4)) == hot)
    m = t.merge(more, ["k"], _last)
    after = t.parts()
    assert m.buckets_split == 1 and {p: f for p, f in after.items() if not p.startswith(hot)} == {p: f for p, f in before.items() if p != hot}
    assert t.read().count() == 150 + more.count()


def test_directory_covers_every_hash_once(spark):
    names = ["b0", "b10", "b110", "b111"]
    got = spark.range(1000).select(F.xxhash64("id").alias("h")).select("h", bucket_in(F.col("h"), names).alias("b")).collect()
    for h, b in got:
        bits = format(h & ((1 << 40) - 1), "040b")[::-1]
        assert [n for n in names if bits.startswith(n[1:])] == [b]
    assert directory_of(1) == ["b"] and len(directory_of(5)) == 8


# ---------------------------------------------------------------- skipping
@pytest.mark.parametrize("ask_bitmaps_from", [0, 10 ** 9])
def test_new_keys_append_and_old_ones_rewrite_their_segment_only(spark, workdir, monkeypatch, ask_bitmaps_from):
    monkeypatch.setattr(parts_module, "FILTER_FROM", ask_bitmaps_from)
    t = PartsTable(spark, f"{workdir}/t", T.StructType.fromDDL("k long, v int"))
    of = lambda lo, hi, v: spark.range(lo, hi).select(F.col("id").alias("k"), F.lit(v).alias("v"))
    first = t.merge(of(0, 5000, 1), ["k"], _last, buckets=2)
    assert (first.rows_written, first.segments_rewritten) == (5000, 0)
    second = t.merge(of(5000, 5100, 2), ["k"], _last)
    assert (second.rows_written, second.segments_rewritten, second.segments_kept) == (100, 0, 2)
    third = t.merge(of(5000, 5001, 3).unionByName(of(9000, 9001, 3)), ["k"], _last)
    assert third.segments_rewritten == 1 and third.rows_written < 110
    want = [(k, 1) for k in range(5000)] + [(5000, 3)] + [(k, 2) for k in range(5001, 5100)] + [(9000, 3)]
    assert sorted(tuple(r) for r in t.read().collect()) == want
    assert _rows(t.read_version(first.version)) == _rows(of(0, 5000, 1))


def test_many_segments_are_merged_and_null_keys_found(spark, workdir):
    t = PartsTable(spark, f"{workdir}/t", T.StructType.fromDDL("k string, v int"))
    for i in range(parts_module.MAX_SEGMENTS + 1):
        t.merge(spark.createDataFrame([(f"k{i}", i)], "k string, v int"), ["k"], _last)
    assert [len(f) for f in t.parts().values()] == [1] and t.read().count() == parts_module.MAX_SEGMENTS + 1
    keep_null = lambda old, new: old.join(new.select(F.col("k").alias("_k")), F.col("k").eqNullSafe(F.col("_k")), "left_anti").unionByName(new)
    t.merge(spark.createDataFrame([(None, 1)], "k string, v int"), ["k"], keep_null)
    assert t.merge(spark.createDataFrame([(None, 2)], "k string, v int"), ["k"], keep_null).segments_rewritten == 1
    assert [r.v for r in t.read().where("k IS NULL").collect()] == [2]


def test_an_empty_batch_changes_nothing(spark, workdir):
    t = PartsTable(spark, f"{workdir}/t", T.StructType.fromDDL("k long, v int"))
    empty = spark.createDataFrame([], "k long, v int")
    assert t.merge(empty, ["k"], _last).rows_written == 0 and t.read().count() == 0
    t.merge(spark.createDataFrame([(1, 1)], "k long, v int"), ["k"], _last)
    before = t.parts()
    t.merge(empty, ["k"], _last)
    assert t.parts() == before


# ---------------------------------------------------------------- schema history
def test_parts_of_older_types_are_widened_and_narrowings_refused(spark, workdir):
    t = PartsTable(spark, f"{workdir}/t")
    part = F.pmod("k", F.lit(2))
    t.replace(spark.createDataFrame([(1, 7, 1.5), (2, 8, 2.123456789)], "k int, code int, amount double"), part)
    new = spark.createDataFrame([(3, "x9", "3.25")], "k int, code string, amount string").select("k", "code", F.col("amount").cast("decimal(23,8)").alias("amount"))
    t.replace(new, part, ["1"], schema=new.schema)
    assert t.read().schema.simpleString() == "struct<k:int,code:string,amount:decimal(23,8)>"
    assert [(r.k, r.code, str(r.amount)) for r in t.read().orderBy("k").collect()] == [(2, "8", "2.12345679"), (3, "x9", "3.25000000")]
    before = t.current()
    for ddl in ("k int, code int, amount decimal(23,8)", "k int, code string, amount decimal(10,2)", "k int, code string, amount double"):
        narrow = T.StructType.fromDDL(ddl)
        with pytest.raises(ValueError, match="narrower"):
            t.replace(spark.createDataFrame([], ddl), part, ["1"], schema=narrow)
    assert t.current() == before and t.read().count() == 2


def test_a_key_that_changes_type_is_dealt_anew(spark, workdir):
    t = PartsTable(spark, f"{workdir}/t", T.StructType.fromDDL("k int, v int"))
    t.merge(spark.range(100).select(F.col("id").cast("int").alias("k"), F.lit(1).alias("v")), ["k"], _last, buckets=4)
    wide = T.StructType.fromDDL("k string, v int")
    t.merge(spark.createDataFrame([("5", 2), ("x", 2)], wide), ["k"], _last, schema=wide)
    got = {r.k: r.v for r in t.read().collect()}
    assert len(got) == 101 and got["5"] == 2 and got["x"] == 2 and got["6"] == 1


# ---------------------------------------------------------------- mirror and stream
def test_stream_matches_columns_by_header_and_takes_new_ones(spark, workdir):
    base, mpath, ckpt = f"{_local(workdir)}/d", f"{workdir}/m", f"{workdir}/c"
    seed = spark.createDataFrame([(1, "x0", "y0"), (2, "x0", "y0")], "id int, x string, y string")
    delta_stream.seed_mirror(spark, seed, mpath, ["id"])
    for did, text in ((1000, "id;y;x\n1;newY;newX\n"), (1001, "x;id;y;z\nx2;2;y2;z2\n")):
        os.makedirs(f"{base}/delta_id={did}", exist_ok=True)
        Path(f"{base}/delta_id={did}/part-0.csv").write_text(text)
        delta_stream.start_mirror_stream(spark, base, seed.schema, ["id"], mpath, ckpt).awaitTermination()
    assert _rows(delta_stream.read_mirror(spark, mpath).select("id", "x", "y", "z")) == [(1, "newX", "newY", None), (2, "x2", "y2", "z2")]


def test_a_load_and_a_mirror_run_parse_their_files_once(spark, workdir, monkeypatch):
    reads = []
    for module, name in ((mirror, "read_deltas"),):
        real = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, _real=real, **k: reads.append(1) or _real(*a, **k))
    base = f"{_local(workdir)}/d"
    os.makedirs(f"{base}/1000")
    Path(f"{base}/1000/t.csv").write_text("k;v\n1;a\n")
    seen = []
    real_merge = PartsTable.merge
    monkeypatch.setattr(PartsTable, "merge", lambda self, batch, *a, **k: seen.append(batch.inputFiles()) or real_merge(self, batch, *a, **k))
    mirror.delta_loading(spark, "t", ["k"], base, f"{workdir}/log", f"{workdir}/m", spark.createDataFrame([(1, "s")], "k int, v string"))
    f = _file(workdir, "one.csv", HEADER + "1;2018-01-01;2018-01-31;30;12.5;643\n")
    load_table(spark, TABLES["md_exchange_rate_d"], f, f"{workdir}/ds")
    assert len(reads) == 1 and len(seen) == 2
    assert all(name.endswith(".parquet") for files in seen for name in files)      # merged from staged rows, no file is parsed again
    for files in seen:
        assert not any(os.path.exists(n.replace("file://", "")) for n in files)    # and these are gone


# ---------------------------------------------------------------- run ids and sessions
def test_runs_that_start_together_get_different_ids(spark, workdir):
    path = f"{workdir}/log"
    runlog.write_log(spark, path, "old run", 4, "test")
    with ThreadPoolExecutor(20) as pool:
        ids = list(pool.map(lambda _: runlog.claim_run_id(spark, path), range(20)))
    assert sorted(ids) == list(range(5, 25))
    assert AppendLog(spark, path, LOG_INFO).read().count() == 1
    assert runlog.RunLogger(spark, path).run_id == 25


def test_a_local_session_without_a_preset_folder():
    code = ("from ledgerlake.session import fresh_dir, local_session; s = local_session('1'); "
            "a, b = fresh_dir(s, 'a'), fresh_dir(s, 'b'); s.range(3).write.parquet(a); print(s.read.parquet(a).count(), a.rsplit('/', 1)[0] == b.rsplit('/', 1)[0])")
    env = os.environ | {"SPARK_CONF_DIR": tempfile.mkdtemp(prefix="empty-conf-")}
    out = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parent.parent, env=env, capture_output=True, text=True, timeout=200, check=True)
    assert out.stdout.split() == ["3", "True"]


def test_many_parts_are_listed_in_few_tasks(spark, workdir):
    most = parts_module.LISTERS_A_CORE * spark.sparkContext.defaultParallelism
    table, n = PartsTable(spark, f"{workdir}/listed"), most + 40
    table.replace(spark.range(n), F.col("id"))
    before, sc = spark.conf.get(parts_module._LISTERS), spark.sparkContext
    sc.setJobGroup("listing", "listing")
    try:
        rows = table.read()
        tracker = sc.statusTracker()
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert stages and max(s.numTasks for s in stages) <= most
    assert rows.count() == n and spark.conf.get(parts_module._LISTERS) == before
