import datetime as dt
import json

import pytest
from conftest import rows

from tidewell import api
from tidewell.__main__ import main
from tidewell.sources import store
from tidewell.sources.archives import read_zstd, write_zstd


def test_tasks(spark, tmp_path):
    zstandard = pytest.importorskip("zstandard")
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    lines = [json.dumps({"id": f"i{k}", "author": f"a{k % 3}", "odd": k}) for k in range(20)] + ["bad", ""]
    (src / "RC_2005-01.zst").write_bytes(zstandard.ZstdCompressor().compress("\n".join(lines).encode()))
    (src / "RS_2005-02.json").write_text('{"id":"s"}\n')
    got = api.convert(spark, str(src), str(out))
    assert sorted((s["table"], s["rows"], s["bad"]) for s in got) == [("new-RC_2005-01.parquet", 20, 1), ("new-RS_2005-02.parquet", 1, 0)]
    assert api.convert(spark, str(src), str(out)) == [] and len(api.convert(spark, str(src), str(out), only="RC_2005-01.zst", force=True)) == 1
    with pytest.raises(ValueError):
        api.convert(spark, str(src), str(out), force=True)
    assert rows(api.verify(spark, str(out)), "filename", "status", "errors") == [("new-RC_2005-01.parquet", "ok", []), ("new-RS_2005-02.parquet", "ok", [])]
    assert api.verify(spark, str(out), offset=1, limit=5).count() == 1
    (out / "new-RC_2005-01.parquet.manifest.json").unlink()
    assert rows(api.verify(spark, str(out)).filter("status = 'failed'"), "errors") == [(["no manifest"],)]
    m = api.manifests(spark, str(out), full=True)
    assert m.agg({"row_count": "sum"}).first()[0] == 21 and m.filter("size(columns) = size(schema) AND column_stats['id'].usage_ratio = 1.0").count() == m.count()
    assert api.drift(spark, [str(out)]).filter("column_name = 'id' AND type = 'string'").first().n_sources == m.count()
    (src / "RC_2005-01.claim.json").write_text('{"zst_filename":"RC_2005-01.zst","machine_meta":{"machine":"m","ip":"1"},"started_at":"2020-01-01T00:00:00"}')
    (src / "new-RC_2005-01.parquet.manifest.json").write_text(json.dumps({"filename": "new-RC_2005-01.parquet", "conversion_history": {"machine": {"machine": "m", "ip": "1"}, "stages": {"conversion": {"duration_sec": 2.0}}}}))
    r = api.report(spark, str(src), dt.datetime(2020, 1, 1, 1))
    assert r["status"].first().done_files == 1 and r["estimate"].first().source == "observed" and rows(r["claims"], "stale", "ghost") == [(False, False)]
    assert rows(r["timeline"], "months") == [("X - - - - - - - - - - -",)]


def test_command_line(spark, capsys, tmp_path):
    with pytest.raises(SystemExit):
        main(["convert", "a", "b", "--force"])
    assert main(["precheck"]) == 0 and "rows 3" in capsys.readouterr().out
    (tmp_path / "a.toml").write_text('[paths]\na = 1\nb = 2\n')
    (tmp_path / "b.toml").write_text('[paths]\nb = 3\n[more]\nc = 4\n')
    assert api.settings(str(tmp_path / "a.toml"), str(tmp_path / "b.toml"), str(tmp_path / "none.toml")) == {"paths": {"a": 1, "b": 3}, "more": {"c": 4}}
    assert store.write_text(spark, str(tmp_path / "c"), "1") and not store.write_text(spark, str(tmp_path / "c"), "2", replace=False) and (tmp_path / "c").read_text() == "1"
    assert store.write_text(spark, str(tmp_path / "c"), "3") and store.read_text(spark, str(tmp_path / "c")) == "3" and [p.name for p in tmp_path.glob("c*")] == ["c"] and store.read_text(spark, str(tmp_path / "none")) is None


def test_one_claim_of_many(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda k: store.claim(spark, str(tmp_path / "x.claim.json"), str(k)), range(16)))
    assert got.count(True) == 1 and (tmp_path / "x.claim.json").read_text() == str(got.index(True))


def test_paths_stay_inside(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "link").symlink_to(tmp_path)
    base = str(tmp_path / "in")
    assert store.contained(base, "/a/../b") == f"{base}/b" and store.contained(base, "") == base and store.contained("hdfs://h/x", "y/z") == "hdfs://h/x/y/z"
    for bad in ("..", "a/../../b", "/../x", "link/x"):
        with pytest.raises(ValueError):
            store.contained(base, bad)
    with pytest.raises(ValueError):
        store.contained("hdfs://h/x", "../y")


def test_archives_written_and_read(spark, tmp_path):
    lines = [(f"RC_2005-0{k % 3 + 1}.zst", f"line {k} é") for k in range(500)]
    wrote = write_zstd(spark.createDataFrame(lines, "name string, value string").repartition(4), str(tmp_path))
    assert rows(wrote) == [("RC_2005-01.zst", 167), ("RC_2005-02.zst", 167), ("RC_2005-03.zst", 166)] and sorted(p.name for p in tmp_path.iterdir()) == [n for n, _ in rows(wrote)]
    files = spark.createDataFrame([(str(p),) for p in tmp_path.iterdir()], "path string")
    assert sorted(r.value for r in read_zstd(files).collect()) == sorted(v for _, v in lines)
    assert read_zstd(files, first_lines=2).count() == 6


def test_conversion_of_many_archives(spark, tmp_path, monkeypatch):
    """Each archive is decoded once; empty and all-bad ones become empty tables; a test run takes the first lines."""
    src = tmp_path / "in"
    line = lambda k: json.dumps({"id": f"i{k}", "author": f"a{k % 3}", "created_utc": k})
    data = [("RC_2005-01.zst", line(k)) for k in range(30)] + [("RC_2005-02.zst", "bad"), ("RC_2005-02.zst", "[1]")] + [("RS_2005-01.zst", line(k)) for k in range(5)]
    write_zstd(spark.createDataFrame(data, "name string, value string"), str(src))
    write_zstd(spark.createDataFrame([("RC_2005-03.zst", "")], "name string, value string"), str(src))
    calls, stored = [], []
    real, real_cut = api.read_zstd, api.cut
    monkeypatch.setattr(api, "read_zstd", lambda files, **k: calls.append(sorted(r.path.split("/")[-1] for r in files.collect())) or real(files, **k))
    monkeypatch.setattr(api, "cut", lambda df: stored.append(df) or real_cut(df))
    got = api.convert(spark, str(src), str(tmp_path / "out"))
    assert sorted((s["table"], s["rows"], s["bad"]) for s in got) == [("new-RC_2005-01.parquet", 30, 0), ("new-RC_2005-02.parquet", 0, 2), ("new-RC_2005-03.parquet", 0, 0), ("new-RS_2005-01.parquet", 5, 0)]
    assert sorted(calls) == [["RC_2005-01.zst", "RC_2005-02.zst", "RC_2005-03.zst"], ["RS_2005-01.zst"]] and len(stored) == 2
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.endswith(".json")) == ["new-RC_2005-01.parquet", "new-RC_2005-02.parquet", "new-RC_2005-02.parquet.bad", "new-RC_2005-03.parquet", "new-RS_2005-01.parquet"]
    assert rows(api.verify(spark, str(tmp_path / "out")), "status") == [("ok",)] * 4
    t = spark.read.parquet(str(tmp_path / "out" / "new-RC_2005-01.parquet")).select("author", "created_utc").collect()
    assert [tuple(r) for r in t] == sorted((f"a{k % 3}", k) for k in range(30))
    assert api.convert(spark, str(src), str(tmp_path / "test"), only="RC_2005-01.zst", first_lines=4)[0]["rows"] == 4


def test_types_that_differ_between_files(spark, tmp_path):
    """A table whose files have two types of a column, or lack one, fails, every time."""
    from tidewell.schema import master_schema

    table = tmp_path / "new-RC_2005-01.parquet"
    whole = spark.createDataFrame([], master_schema("rc"))
    whole.coalesce(1).write.parquet(str(table / "a"))
    whole.withColumn("score", whole["score"].cast("string")).drop("body").coalesce(1).write.parquet(str(table / "b"))
    store.write_text(spark, f"{table}.manifest.json", json.dumps({"filename": table.name, "schema": {f.name: f.dataType.simpleString() for f in whole.schema}}))
    for _ in range(2):
        got = api.verify(spark, str(tmp_path)).first()
        assert got.status == "failed" and "several types: score" in got.errors and "not in all files: body" in got.errors


def test_manifests_of_flat_and_nested_files(spark, tmp_path):
    """Counts of flat files come from footers, others from the rows; both are what the rows say."""
    flat = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string")
    nested = spark.createDataFrame([([1], "x"), (None, "y")], "l array<int>, b string")
    flat.coalesce(1).write.parquet(str(tmp_path / "f"))
    nested.repartition(2).write.parquet(str(tmp_path / "n é"))
    (tmp_path / "broken.parquet").write_text("no")
    got = api.manifests(spark, str(tmp_path), full=True).collect()
    assert len(got) == 3 and sorted(sum(r.column_stats[c]["count"] for r in got if c in r.column_stats) for c in "abl") == [1, 2, 3]
    assert all(s["usage_ratio"] == round(s["count"] / r.row_count, 4) for r in got for s in r.column_stats.values())
    out = str(tmp_path / "drift.json")
    api.drift(spark, [str(tmp_path)], out=out)
    found = json.loads((tmp_path / "drift.json").read_text())
    assert found["files"] == 4 and found["errors"] == 1 and list(found["column_frequencies"].values()) == sorted(found["column_frequencies"].values())


def test_profile_of_loads(spark, tmp_path):
    a = spark.createDataFrame([(9, "x"), (100, None)], "n int, s string")
    b = spark.createDataFrame([(20, "y")], "n int, s string")
    api.profile_load(spark, str(tmp_path / "p"), "1", a)
    got = {(r["load"], r.column_name): r for r in api.profile_load(spark, str(tmp_path / "p"), "2", b, a.filter("n = 100")).collect()}
    assert (got["1", "n"].least, got["1", "n"].most, got["2", "n"].most, got["2", "n"].n_rows, got["2", "s"].n_null) == ("9", "100", "20", 2, 0)


def test_settings(spark, tmp_path, capsys):
    (tmp_path / "a.toml").write_text('[spark]\nmaster = "yarn"\nshuffle_partitions = 0\n[paths]\nin = ""\n[remote]\npassword = "p"\nhost = "h"\n')
    found = api.settings(str(tmp_path / "a.toml"))
    assert len(api.problems_of(found)) == 3 and api.problems_of({}) == []
    assert dict(rows(api.shown(spark, found).filter("section = 'remote'"), "key", "value")) == {"password": "<redacted>", "host": "h"}
    assert main(["config", "--validate", str(tmp_path / "a.toml")]) == 1 and "checkpoint_dir" in capsys.readouterr().out
