import json

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewell.functions.coerce import coerce, edited_text, text_to_bigint
from tidewell.operators.layout import read_union, sort_global, write_table
from tidewell.operators.normalize import normalize, pad, parse, promote, quarantine, rebuild
from tidewell.schema import BIGINT, BOOLEAN, RC, RS, declared_schema, keep_simple, kept_fields, master_schema, shapes, sql_name
from tidewell.sources.archives import catalog, described_types, footers, read_zstd, usage_statistics
from tidewell.streaming.ingest import ingest


def lines(spark, *records):
    return spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in records], "value string")


def test_column_lists():
    assert len(RC) == 57 and len(RS) == 150 and len(BIGINT) == 15 and len(BOOLEAN) == 26
    assert len(master_schema("rc")) == 58 and master_schema("rs")[-1].name == "extra_json"
    kinds = [f.dataType for f in master_schema("rc")]
    assert sum(isinstance(k, T.LongType) for k in kinds) == 10 and sum(isinstance(k, T.BooleanType) for k in kinds) == 9


EDITED = [(False, 0), (True, 1), (None, None), (1600000000, 1600000000), (1600000000.0, 1600000000), ("1600000000", 1600000000), ("x", None), ({"x": 1}, None)]


def test_edited(spark):
    df = normalize(lines(spark, *[{"id": str(i), "edited": v} for i, (v, _) in enumerate(EDITED)], {"id": "z"}), "rc")
    assert rows(df, "id", "edited") == sorted([*((str(i), w) for i, (_, w) in enumerate(EDITED)), ("z", None)], key=repr)
    assert normalize(lines(spark, {"edited": 1600000000}), "rc", edited_mode="sql").first().edited == 1
    t = spark.createDataFrame([("true",), ("false",), ("160",), ("x",), (None,)], "s string")
    assert [r[0] for r in t.select(edited_text(F.col("s"))).collect()] == [1, 0, 160, None, None]


SCORES = [("12", 12), (" 7 ", 7), ("1.5", 2), ("2.5", 3), ("-2.5", -3), (2.5, 2), (1.5, 2), ("1e3", 1000), ("x", None), (99999999999999999999, None), (9007199254740993, 9007199254740993), (True, 1), ([1], None), (1e30, None)]


def test_bigint(spark):
    df = normalize(lines(spark, *[{"id": str(i), "score": v} for i, (v, _) in enumerate(SCORES)]), "rc")
    assert {r.id: r.score for r in df.collect()} == {str(i): w for i, (_, w) in enumerate(SCORES)}
    one = spark.createDataFrame([("9007199254740993.0",)], "s string")
    assert one.select(text_to_bigint(F.col("s"))).first()[0] == 9007199254740993


FLAGS = [("yes", True), ("0", False), (1, True), (2, True), (0, False), ("2", None), ("abc", None), (True, True), (None, None)]


def test_boolean(spark):
    df = normalize(lines(spark, *[{"id": str(i), "stickied": v} for i, (v, _) in enumerate(FLAGS)]), "rc")
    assert {r.id: r.stickied for r in df.collect()} == {str(i): w for i, (_, w) in enumerate(FLAGS)}


def test_text_overflow_and_quarantine(spark):
    raw = ['{"id":"a","gildings":{"x":[1, 2.50],"y":"q"},"body":"\\u00e9 漢"}', '{"id":"b","gildings":"p","new_field":{"k":null},"n":null}', "{bad", "[1]", "5", "", "   ", '{"id":"e","body":"x\ty"}', '{"id":"d","id":"c2","n":{"a":1,"a":2}}', '{"id":"c","author_cakeday":true}']
    src = spark.createDataFrame([(r,) for r in [*raw, None]], "value string")
    parsed = parse(src, master_schema("rc"))
    assert {r.value for r in quarantine(parsed).collect()} == {"5", "[1]", "{bad", '{"id":"e","body":"x\ty"}'}
    got = {r.id: r for r in normalize(src, "rc").collect()}
    assert got["a"].gildings == '{"x":[1,2.5],"y":"q"}' and got["a"].body == "é 漢" and got["a"].extra_json is None
    assert got["b"].gildings == "p" and json.loads(got["b"].extra_json) == {"new_field": {"k": None}, "n": None}
    assert got["c"].author_cakeday == "true" and len(got) == 4 and got["c2"].extra_json == '{"n":{"a":2}}'


def test_one_schema_and_lossless(spark):
    recs = [{"id": "a", "score": 5, "weird": [1, {"z": "q"}]}, {"id": "b", "odd": "t"}, {}]
    df = normalize(lines(spark, *recs), "rc")
    assert df.schema == T.StructType([T.StructField(f.name, f.dataType, df.schema[f.name].nullable) for f in master_schema("rc")])
    back = [json.loads(r.record_json) for r in rebuild(df).collect()]
    assert sorted(back, key=len) == sorted(recs, key=len)


def test_parsed_once(spark):
    plan = normalize(lines(spark, {"id": "a"}), "rs")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" in plan and not any("json" in line for line in plan.splitlines() if "Filter" in line)


def test_coerce_nested(spark):
    to = T.StructType.fromDDL("a struct<x:bigint,y:array<string>>, b array<bigint>, c double, d boolean")
    src = lines(spark, {"a": {"x": "4", "y": "one", "z": 1}, "b": [1, "2", None], "c": "1.5", "d": "t"}, {"a": 3, "b": {"k": 1}, "c": {}, "d": []}, {"a": None, "b": 7})
    got = [r.asDict(recursive=True) for r in promote(parse(src, to), to).collect()]
    assert got[0] == {"a": {"x": 4, "y": ["one"]}, "b": [1, 2, None], "c": 1.5, "d": True}
    assert got[1] == {"a": None, "b": None, "c": None, "d": None}
    assert got[2] == {"a": None, "b": [7], "c": None, "d": None}
    assert coerce is not None


def test_types_and_usage(spark, tmp_path):
    stats = {
        "id": [{"type": "string", "usage": 0.01}], "rare": [{"type": "int", "usage": 0.05}], "edited": [{"type": "bool", "usage": "always"}], "n": [{"type": "int", "usage": 0.1}, {"type": "string", "usage": 0.9}], "z": [{"type": "null", "usage": 1}], "odd": [{"type": "??", "usage": 1}],
        "l": [{"type": "array", "usage": 1}], "kv": [{"type": "key-value", "usage": 1, "schema": {"a": [{"type": "int"}]}}], "bare": [{"type": "object", "usage": 1}],
        "deep": [{"type": "object", "usage": 0.5, "schema": {"b": [{"type": "bool"}], "a `x": [{"type": "array", "schema": [{"type": "object", "schema": {"f": [{"type": "float"}]}}]}]}}],
    }
    (tmp_path / "s.json").write_text(json.dumps([{"schema": stats}]))
    types = described_types(spark, str(tmp_path / "s.json"))
    got = {f.name: f.dataType.simpleString() for f in declared_schema(usage_statistics(spark, str(tmp_path / "s.json")), types)}
    assert got == {"bare": "string", "deep": "struct<a `x:array<struct<f:double>>,b:boolean>", "edited": "bigint", "id": "string", "kv": "string", "l": "array<string>", "n": "bigint", "odd": "string", "z": "string", "extra_json": "string"} and list(got)[-1] == "extra_json"
    assert shapes(types.limit(0)).count() == 0
    assert rows(spark.createDataFrame([("bigint",), ("int64",), ("list<item: int64>",), ("struct<a:int>",), ("string",), ("bool",), ("timestamp",), (None,)], "t string").select("t", sql_name(F.col("t")))) == sorted([("bigint", "BIGINT"), ("int64", "BIGINT"), ("list<item: int64>", "JSON"), ("struct<a:int>", "JSON"), ("string", "VARCHAR"), ("bool", "BOOLEAN"), ("timestamp", "VARCHAR"), (None, "VARCHAR")], key=repr)
    u = spark.createDataFrame([("id", 0, "string", "0.01"), ("rare", 0, "int", "0.05"), ("n", 0, "int", "0.1"), ("n", 1, "string", "0.9"), ("all", 0, "int", "always"), ("bad", 0, "int", None)], "field string, rank int, type string, usage string")
    assert rows(kept_fields(u), "field", "type") == [("all", "int"), ("id", "string"), ("n", "int")]
    assert keep_simple(spark.createDataFrame([(1, [1], {"a": 1})], "a int, b array<int>, c map<string,int>")).columns == ["a"]


def test_layout(spark, tmp_path):
    t = [("b", None, 2), (None, "x", 1), ("b", "s", 1), ("a", "s", None), ("a", "s", 3), (None, None, None)]
    df = spark.createDataFrame(t * 50, "author string, subreddit string, created_utc bigint").repartition(5)
    write_table(sort_global(df, partitions=3), str(tmp_path / "a.parquet"))
    out = [tuple(r) for p in sorted((tmp_path / "a.parquet").glob("*.parquet")) for r in spark.read.parquet(str(p)).collect()]
    assert out == sorted(t * 50, key=lambda r: [(v is None, v or "") if not isinstance(v, int) else (False, v) for v in r])
    write_table(spark.createDataFrame([("1", "7")], "id string, score string"), str(tmp_path / "b.parquet"))
    both = read_union(spark, [str(tmp_path / "a.parquet"), str(tmp_path / "b.parquet")], "rc")
    assert both.count() == 301 and both.filter("id = '1'").first().score == 7
    more = pad(spark.createDataFrame([(1, None)], "id int, other string"), master_schema("rc")).first()
    assert more.id == "1" and more.extra_json == '{"other":null}'


def test_sources(spark, tmp_path):
    zstandard = pytest.importorskip("zstandard")
    text = "".join(json.dumps({"id": f"i{i}", "body": "x" * i}) + "\n" for i in range(50)).encode() + b'{"id":"bad \xff"}\n\n'
    (tmp_path / "RC_2005-01.zst").write_bytes(zstandard.ZstdCompressor().compress(text[:900]) + zstandard.ZstdCompressor().compress(text[900:]))
    params = zstandard.ZstdCompressionParameters.from_level(1, window_log=31, enable_ldm=True)
    c = zstandard.ZstdCompressor(compression_params=params).compressobj()
    (tmp_path / "RS_2005-02.zst").write_bytes(c.compress(text) + c.flush())
    cat = catalog(spark, str(tmp_path), "*.zst")
    assert rows(cat, "name", "kind", "year", "month") == [("RC_2005-01.zst", "rc", 2005, 1), ("RS_2005-02.zst", "rs", 2005, 2)]
    got = read_zstd(cat)
    assert got.groupBy("path").count().filter("count = 52").count() == 2
    assert normalize(got, "rc").filter("id = 'bad �'").count() == 2
    write_table(spark.range(5).selectExpr("id", "'x' AS body"), str(tmp_path / "t"))
    (tmp_path / "t" / "broken.parquet").write_bytes(b"PAR1nothing")
    f = footers(catalog(spark, str(tmp_path / "t"), "*.parquet"))
    assert f.filter("column_name = 'body' AND type = 'string'").count() >= 1 and f.filter("error IS NOT NULL").count() == 1


def test_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    for i, part in enumerate((['{"id":"a"}', "bad"], ['{"id":"b","k":1}'])):
        (src / f"{i}.json").write_text("\n".join(part) + "\n")
        ingest(spark, str(src), "rc", str(tmp_path / "out"), str(tmp_path / "state"), bad=str(tmp_path / "bad")).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out")).count() == i + 1
    assert spark.read.text(str(tmp_path / "bad")).count() == 1
