import datetime as dt
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidewell.functions import formats as fm
from tidewell.operators import audit, fleet, layout, profiling
from tidewell.schema import RC
from tidewell.sources.archives import CLAIM, MANIFEST, read_json_files, usage_statistics


def one(spark, c):
    return spark.range(1).select(c).first()[0]


def test_formats(spark):
    for n, want in ((0, "0 B"), (1023, "1023 B"), (1024, "1.0 KB"), (1600, "1.6 KB"), (5 * 2**20, "5.0 MB"), (3 * 2**30, "3.0 GB"), (None, "N/A")):
        assert one(spark, fm.format_size(F.lit(n).cast("bigint"))) == want
    assert one(spark, fm.format_size_long(F.lit(0))) == "0B" and one(spark, fm.format_size_long(F.lit(2**40))) == "1.00 TB"
    assert one(spark, fm.format_speed(F.lit(100), F.lit(0))) == "N/A" and one(spark, fm.format_speed(F.lit(2048), F.lit(1))) == "2.0 KB/s"
    assert one(spark, fm.format_seconds(F.lit("x"))) == "N/A" and one(spark, fm.format_seconds(F.lit("12.345"))) in ("12.35s", "12.34s")
    assert one(spark, fm.format_mb_s(F.lit(None).cast("string"), F.lit(False))) == "-" and one(spark, fm.format_mb_s(F.lit("45.678"), F.lit(True))) == "45.68 MB/s"
    assert one(spark, fm.elapsed(F.lit(59.9))) == "59s" and one(spark, fm.elapsed(F.lit(125))) == "2m 5s"
    assert one(spark, fm.mb_per_s(F.lit(2**21), F.lit(4))) == 0.5 and one(spark, fm.mb_per_s(F.lit(2**21), F.lit(0))) == 0.0
    a = F.lit("RC_2005-12.zst")
    assert one(spark, fm.table_name(a)) == "new-RC_2005-12.parquet" and one(spark, fm.claim_name(a)) == "RC_2005-12.claim.json"
    assert one(spark, fm.archive_name(fm.manifest_name(a))) == "RC_2005-12.zst" and one(spark, fm.archive_part(F.lit("RC_2005-12.zst.x"), 1)) is None
    assert one(spark, fm.chunk_number(F.lit("chunk_00012.parquet"))) == 12 and one(spark, fm.redact(F.lit("ftp_PASSWORD"), F.lit("x"))) == "<redacted>" and one(spark, fm.redact(F.lit("host"), F.lit("x"))) == "x"


def test_verify(spark):
    good = {c: "string" for c in [*RC, "extra_json"]} | {"edited": "int64"}
    missing = {c: t for c, t in good.items() if c not in ("body", "extra_json")} | {"odd": "string", "edited": "bool"}
    t = spark.createDataFrame([("new-RC_1.parquet", good), ("new-RC_2.parquet", missing), ("other.parquet", good), ("new-RC_3.parquet", None), ("new-RC_4.parquet", good), ("new-RC_5.parquet", None)], "filename string, types map<string,string>")
    m = spark.createDataFrame([("new-RC_1.parquet", good), ("new-RC_2.parquet", good | {"edited": "int64"}), ("new-RC_3.parquet", good)], "filename string, types map<string,string>")
    got = {r.filename: r for r in audit.verify(t, m).collect()}
    assert {f: r.status for f, r in got.items()} == {"new-RC_1.parquet": "ok", "new-RC_2.parquet": "failed", "other.parquet": "skipped", "new-RC_3.parquet": "ok", "new-RC_4.parquet": "failed", "new-RC_5.parquet": "failed"}
    assert got["new-RC_2.parquet"].errors == ["missing columns: body", "unexpected columns: odd", "no extra_json column", "not in the manifest: odd", "only in the manifest: body, extra_json", "other types in the manifest: edited", "edited must be int64, is bool"]
    assert got["new-RC_4.parquet"].errors == ["no manifest"]
    assert dict(rows(audit.tally(audit.verify(t, m)))) == {"ok": 2, "failed": 3, "skipped": 1, "total": 6}


def test_profiles(spark):
    df = spark.createDataFrame([("hello", None), (None, None)], "body string, extra_json string")
    assert rows(profiling.column_profile(df)) == [("body", 1, 2, 0.5), ("extra_json", 0, 2, 0.0)]
    assert rows(profiling.column_profile(df.limit(0)), "usage_ratio") == [(0.0,), (0.0,)]
    stats = audit.full_manifest(df).first()
    assert stats.row_count == 2 and stats.column_stats["body"].asDict() == {"count": 1, "usage_ratio": 0.5}
    d = profiling.schema_drift(spark.createDataFrame([("c1", "a", "INT"), ("c2", "a", "TEXT"), ("c2", "b", "INT"), ("c2", "b", "INT")], "source string, column_name string, type string"))
    assert rows(d, "column_name", "type", "n_sources", "n_types") == [("a", "INT", 1, 2), ("a", "TEXT", 1, 2), ("b", "INT", 1, 1)]
    c = profiling.contiguity(spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("b", 4), ("b", 4)], "g string, n int"), "g", "n")
    assert rows(c) == [("a", 2, 2, True, ""), ("b", 4, 2, False, "2,3")]
    r = profiling.reconcile(spark.createDataFrame([("a",), ("a",), ("b",)], "k string"), spark.createDataFrame([("a",), ("b",), ("c",)], "k string"), ["k"])
    assert rows(r) == [("a", 2, 1, "short"), ("b", 1, 1, "ok"), ("c", 0, 1, "over")]


def test_rank(spark):
    t = [(k % 7 if k % 5 else None, k) for k in range(200)]
    got = layout.rank_global(spark.createDataFrame(t, "a int, b int").repartition(4), ["a", "b"])
    assert [(r.a, r.b) for r in got.orderBy("place").collect()] == sorted(t, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert sorted(r.place for r in got.collect()) == list(range(1, 201))


def test_fleet(spark):
    arch = spark.createDataFrame([("RC_2005-01.zst", 100), ("RC_2005-03.zst", 300), ("RS_2006-02.zst", 0), ("x", 0)], "name string, size bigint")
    done = spark.createDataFrame([("RC_2005-01.zst",), ("RC_2005-01.zst",), ("unknown",)], "name string")
    assert fleet.status(arch, done).first().asDict() == {"total_bytes": 400, "done_bytes": 100, "pending_bytes": 300, "done_share": 25.0, "total_files": 4, "done_files": 1, "file_share": 25.0}
    assert fleet.status(arch.limit(0), done).first().done_share is None
    assert rows(fleet.timeline(fleet.archive_months(arch, done))) == [("RC", 2005, "X - . - - - - - - - - -"), ("RS", 2006, "- . - - - - - - - - - -")]
    now = dt.datetime(2020, 1, 2)
    c = spark.createDataFrame([("a", "m", "2020-01-01T23:00:00", None), ("b", "m", "2020-01-01", "2020-01-01 20:30:00"), ("c", "m", "junk", None), ("d", "n", None, None), ("e", "o", "2019-01-01T00:00:00Z", "junk")], "f string, machine string, started_at string, updated_at string")
    aged = fleet.claim_ages(c, now)
    assert rows(aged, "f", "stale") == [("a", False), ("b", False), ("c", False), ("d", False), ("e", False)]
    assert rows(fleet.claim_ages(c, now, "3 hours").filter("stale"), "f") == [("b",)]
    assert rows(fleet.latest_per_key(aged, "machine", "at", "f").filter("place = 1"), "f") == [("a",), ("d",), ("e",)]
    fixed = fleet.repaired_machines(spark.createDataFrame([("b�d", "1"), ("ok", "1"), ("b�d", "9")], "machine string, ip string"), spark.createDataFrame([("good", "1")], "machine string, ip string"))
    assert sorted(r.machine for r in fixed.collect()) == ["b�d", "good", "ok"]
    runs = spark.createDataFrame([("m", "1", 2.0, 4.0, 0.0, 2**30, 10), ("m", "1", 0.0, 0.0, 5.0, 0, 2**20)], "machine string, ip string, dl_s double, conv_s double, up_s double, archive_bytes bigint, table_bytes bigint")
    s = fleet.machine_stats(runs)
    r = s.first()
    assert (r.n, r.dl_s_per_gib, r.conv_mib_per_s, r.up_bytes, r.total_s) == (2, 2.0, 256.0, 2**20, 11.0)
    assert fleet.completion(2**30, s).first().source == "observed" and fleet.completion(1536 * 2**20, s.limit(0)).first().asDict() == {"mb_per_min": 1536.0, "source": "static", "raw_minutes": 1.0, "cautious_minutes": 1.25}


def test_json_files(spark, tmp_path):
    (tmp_path / "a.manifest.json").write_text('{"filename":"a",\n "schema":{"x":"BIGINT"},"column_stats":{"x":{"count":1,"usage_ratio":0.5}}}')
    (tmp_path / "b.manifest.json").write_text("{broken")
    got = read_json_files(spark, str(tmp_path / "*.manifest.json"), MANIFEST).collect()
    assert len(got) == 1 and got[0].column_stats["x"].usage_ratio == 0.5 and got[0].row_count is None
    (tmp_path / "c.claim.json").write_text('{"zst_filename":"z","machine_meta":{"machine":"m"}}')
    assert read_json_files(spark, str(tmp_path / "*.claim.json"), CLAIM).first().machine_meta.machine == "m"
    (tmp_path / "u.json").write_text('[{"schema":{"a":[{"type":"int","usage":0.5},{"type":"string","usage":0.1}],"b":[{"type":"bool","usage":"always"}]}}]')
    assert rows(usage_statistics(spark, str(tmp_path / "u.json"))) == [("a", 0, "int", "0.5"), ("a", 1, "string", "0.1"), ("b", 0, "bool", "always")]


def test_percent_and_minutes_are_registered(spark):
    from tidewell.plans.catalogue import QUERIES

    sf = "/root/testdata/sf0.001"
    if not Path(sf).exists():
        pytest.skip("no test tables here")
    got = [r.percent for r in QUERIES["running_percent"](spark, sf).orderBy("position").collect()]
    assert got[0] == 6.25 and max(got) <= 100
    one = QUERIES["fleet_estimate"](spark, sf).first()
    assert one.raw_minutes > 0 and abs(one.cautious_minutes - 1.25 * one.raw_minutes) < 2e-4


def test_claims_logs_and_listings(spark):
    now = dt.datetime(2020, 1, 2)
    c = spark.createDataFrame([("a", "m", "1", "2020-01-01T01:00:00"), ("b", "m", None, "2019-12-31T23:00:00"), ("c", None, None, "junk"), ("d", "n", "1", None), ("e", "n", "1", "")], "zst_filename string, machine string, ip string, started_at string")
    assert rows(fleet.expired(c, now).filter("expired"), "zst_filename") == [("b",), ("c",)]
    assert rows(fleet.own_claims(c, "m", None).filter("own"), "zst_filename") == [("b",)] and rows(fleet.own_claims(c, None, None).filter("own"), "zst_filename") == [("c",)]
    log = spark.createDataFrame([("a", "done", "1", None), ("x", "pending", None, "e")], "filename string, status string, last_update string, error string")
    names = spark.createDataFrame([("a", 5), ("b", 6), ("b", 7)], "name string, size bigint")
    assert rows(fleet.with_unlogged(log, names), "filename", "status") == [("a", "done"), ("b", "pending"), ("x", "pending")]
    at = c.withColumn("at", F.col("started_at").try_cast("timestamp")).unionByName(spark.createDataFrame([("a", "later", "9", "", dt.datetime(2021, 1, 1))], "zst_filename string, machine string, ip string, started_at string, at timestamp"))
    assert rows(fleet.work_table(log, names, at), "filename", "status", "size", "listed", "machine") == [("a", "done", 5, True, "later"), ("x", "pending", None, False, None)]
    folders = spark.createDataFrame([("a_parquet_tmp", now), ("b_parquet_tmp", now), ("c_parquet_tmp", dt.datetime(2019, 1, 1)), ("other", now), ("d_parquet_tmp", None)], "name string, modified timestamp")
    jobs = spark.createDataFrame([("a", "done", "1"), ("b", "converting", "1"), ("c", "converting", "1")], "filename string, status string, last_update string")
    assert rows(fleet.orphan_folders(folders, jobs, now), "name", "status") == [("a_parquet_tmp", "done"), ("c_parquet_tmp", "converting"), ("d_parquet_tmp", None)]
    assert fleet.orphan_folders(folders.limit(0), jobs, now).count() == 0


def test_previews_and_text_tables(spark):
    df = spark.createDataFrame([("a", f"f{k:02}") for k in range(12)] + [("b", "x"), (None, "y"), ("b", None)], "status string, name string")
    assert rows(profiling.preview(df, "status", "name")) == sorted([("a", 12, ", ".join(f"f{k:02}" for k in range(10)) + ", ...and 2 more"), ("b", 1, "x"), (None, 1, "y")], key=repr)
    assert [r.k for r in profiling.by_frequency(spark.createDataFrame([("b", 2), ("a", 2), ("c", 1)], "k string, n int"), "n", ["k"]).orderBy("place").collect()] == ["c", "a", "b"]
    t = fm.text_table(spark.createDataFrame([(1, "x", "1"), (2, "longer", None)], "place int, Name string, N string"), ["Name", "N"])
    assert [r.line for r in t.orderBy("place").collect()] == ["+--------+---+", "| Name   | N |", "+--------+---+", "| x      | 1 |", "| longer |   |", "+--------+---+"]
    for names, want in ((["b\ufffdd", "good"], "good"), ([None, ""], "unknown-node"), (["é", "b\ufffd"], "é"), (["b\ufffdé"], "b"), ([], "unknown-node")):
        assert one(spark, fm.host_name(F.array(*[F.lit(n).cast("string") for n in names]).cast("array<string>"))) == want
