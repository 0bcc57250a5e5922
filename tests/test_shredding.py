import json
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidewell.operators.shredding import _EL, _parse_deep, assemble, element_objects, flat_table, kind_of, object_rows, parse, positions, related_tables, shred, shred_value, write_tables

SCHEMA = "id string, extra_json string, path string, kind int"


def brute(x):
    """(field_path, node_path, parent_path) of objects that are array elements."""
    out = set()

    def walk(x, path, field, parent, element):
        if isinstance(x, dict):
            if element:
                out.add((field, path, parent))
                parent = path
            for k, v in x.items():
                walk(v, f"{path}.{k}" if path else k, f"{field}.{k}" if field else k, parent, False)
        elif isinstance(x, list):
            for i, v in enumerate(x):
                walk(v, f"{path}[{i}]", field, parent, True)

    walk(x, "", "", "", False)
    return out


def rand(r, depth):
    k = r.random()
    if depth == 0 or k < 0.3:
        return r.choice([None, True, 1, 2.5, "s", "[]", "{}", {}, []])
    if k < 0.65:
        return [rand(r, depth - 1) for _ in range(r.randrange(4))]
    return {r.choice("abc"): rand(r, depth - 1) for _ in range(r.randrange(4))}


def test_levels_give_positions():
    r = random.Random(1)
    for _ in range(300):
        x = rand(r, 6)
        ok, value = parse(json.dumps(x))
        if type(x) is str:
            continue
        leaves = set()

        def walk(v, path, pos, leaves=leaves):
            if path and (path[-1] is _EL and isinstance(v, dict) or not isinstance(v, (dict, list)) or not v):
                leaves.add((path, pos, kind_of(v)))
            if isinstance(v, dict):
                for k, w in v.items():
                    walk(w, (*path, k), pos)
            elif isinstance(v, list):
                for i, w in enumerate(v):
                    walk(w, (*path, _EL), (*pos, i))

        walk(value, (), ())
        got = {(c.path, pos, c.kind[e]) for c in shred_value(value) for e, pos in positions(c.rep, c.run, c.kind, len(c.steps)) if c.path}
        assert ok and got == leaves


def test_sparse_element_takes_little():
    x = [{"a": 1}] + [{}] * 10_000 + [{"a": 2}]
    chunk = next(c for c in shred_value(parse(json.dumps(x))[1]) if c.path[-1] == "a")
    assert len(chunk.rep) == 3 and list(positions(chunk.rep, chunk.run, chunk.kind, 1)) == [(0, (0,)), (2, (10_001,))]


def test_as_brute_force(spark):
    r = random.Random(2)
    table, want = [], set()
    for i in range(120):
        x = rand(r, 6)
        text = json.dumps(x)
        if r.random() < 0.3:
            text = json.dumps(text)
        if r.random() < 0.2:
            table.append((f"r{i}", text + "}", None, 0))
            continue
        table.append((f"r{i}", text, None, 0))
        if not isinstance(x, str):
            want |= {(f"r{i}", *row) for row in brute(x)}
    table += [(None, '[{"k":1}]', None, 0), ("null", None, None, 0), ("empty", "", None, 0), ("nan", '{"a":[{"b":NaN}]}', None, 0), *table[:10]]
    want.add((None, "", "[0]", ""))
    got = element_objects(shred(spark.createDataFrame(table, SCHEMA).repartition(3), "id", "extra_json"))
    assert rows(got.distinct()) == sorted(want, key=repr)
    assert shred(spark.createDataFrame([], SCHEMA), "id", "extra_json").count() == 0


def test_odd_texts(spark):
    odd = {
        "surrogate": '{"a":[{"\\ud800":"\\udc00x"}]}', "big": '{"a":[{"n":' + "9" * 6000 + "}]}", "twice": '{"a":[{"b":1}],"a":[{},{}]}', "brackets": '{"[]":[{"x.y":[{}]}]}', "deep": "[" * 3_000 + "{}" + "]" * 3_000,
        "string": json.dumps(json.dumps('{"a":[{}]}')), "word": '"abc"', "control": '{"a":"\x01"}', "trail": '{"a":[{}]} x', "long": json.dumps({"a": [{"b": "x" * 2_000_000}]}),
    }
    df = spark.createDataFrame([(k, v, None, 0) for k, v in odd.items()], SCHEMA)
    got = element_objects(shred(df, "id", "extra_json"))
    names = [r.id for r in got.collect()]
    assert sorted(names) == sorted(["surrogate", "big", "twice", "twice", "brackets", "brackets", "deep", "string", "long"])
    assert {(r.field_path, r.node_path, r.parent_path) for r in got.filter("id = 'brackets'").collect()} == {("[]", "[][0]", ""), ("[].x.y", "[][0].x.y[0]", "[][0]")}
    assert got.filter("id = 'deep'").first().node_path == "[0]" * 3_000


@pytest.mark.parametrize("text", ['{"a":[1,-2.5e3,true,null,"\\u00e9"],"b":{}}', "[]", "5", '"x"', " [ { } , [ ] ] "])
def test_deep_parser_agrees(text):
    assert _parse_deep(text) == parse(text if text != '"x"' else '["x"]')[1] or text == '"x"'


@pytest.mark.parametrize("text", ["", "[", "]", "[1,]", "[,1]", '{"a"}', '{"a":1,}', "{1:2}", "[1] 2", "01", "nul", '"a', "[}", "{]"])
def test_deep_parser_refuses(text):
    with pytest.raises(ValueError):
        _parse_deep(text)


def test_tables(spark):
    text = '{"t":"x","p":[{"id":1,"o":[{"k":"a","w":[1,2]},{"k":null}]},{"id":2},5]}'
    long = assemble(shred(spark.createDataFrame([("s", text, None, 0)], SCHEMA), "id", "extra_json"))
    assert rows(flat_table(long, "p", ["id"])) == [("s", "p[0]", "", "1"), ("s", "p[1]", "", "2")]
    assert rows(flat_table(long, "p.o", ["k", "w[1]"])) == [("s", "p[0].o[0]", "p[0]", "a", "2"), ("s", "p[0].o[1]", "p[0]", None, None)]
    assert rows(long.filter("field_path = ''"), "field", "kind", "value") == [("p[2]", "number", "5"), ("t", "string", "x")]


def test_chunks_hold_many_records(spark):
    """A repetition level 0 begins the next record, also where a record's first elements lack the leaf."""
    texts = ['{"a":[{"b":1},{"b":2}]}', '{"a":[{},{},{"b":3}]}', '{"a":[]}', '{"c":0}', '{"a":[{"b":4}]}']
    df = spark.createDataFrame([(f"r{k}", t, None, 0) for k, t in enumerate(texts)], SCHEMA).coalesce(1)
    chunks = shred(df, "id", "extra_json").filter(F.expr("array_join(path, '.', '[]') = 'a.[].b'")).collect()
    assert len(chunks) == 1 and sorted(chunks[0].ids) == ["r0", "r1", "r4"] and chunks[0].rep.count(0) == 3
    long = assemble(shred(df, "id", "extra_json"))
    assert rows(long.filter("field = 'b'"), "id", "node_path", "value") == [("r0", "a[0]", "1"), ("r0", "a[1]", "2"), ("r1", "a[2]", "3"), ("r4", "a[0]", "4")]


def test_wide_tables(spark, tmp_path):
    texts = {"s": '{"t":"x","id":7,"p":[{"id":1,"o":[{"k":"a","K":"b"},{}]},{"id":null}]}', "u": '{"p":[{"q":"r"}]}', "v": "{}"}
    long = assemble(shred(spark.createDataFrame([(k, v, None, 0) for k, v in texts.items()], SCHEMA), "id", "extra_json"))
    assert rows(related_tables(long), "field_path", "n_rows", "columns") == [("", 1, ["id", "t"]), ("p", 3, ["id", "q"]), ("p.o", 2, ["K", "k"])]
    assert sorted(((r.node_path, r.fields) for r in object_rows(long).filter("field_path = 'p'").collect()), key=repr) == [("p[0]", {"id": "1"}), ("p[0]", {"q": "r"}), ("p[1]", {"id": None})]
    out = write_tables(long, str(tmp_path))
    p = spark.read.parquet(out["p"])
    assert p.columns == ["id", "node_path", "parent_path", "_id", "q"] and rows(p) == sorted([("s", "p[0]", "", "1", None), ("s", "p[1]", "", None, None), ("u", "p[0]", "", None, "r")], key=repr)
    assert rows(spark.read.parquet(out["p.o"]), "id", "node_path", "parent_path", "K", "_k") == sorted([("s", "p[0].o[0]", "p[0]", "b", "a"), ("s", "p[0].o[1]", "p[0]", None, None)], key=repr)
    same = assemble(shred(spark.createDataFrame([("s", '{"p":[{"a.b":2,"a":{"b":1}},{"a.b":null}]}', None, 0)], SCHEMA), "id", "extra_json"))
    assert rows(object_rows(same), "node_path", "fields") == [("p[0]", {"a.b": "1"}), ("p[1]", {"a.b": None})]
    assert write_tables(long.limit(0), str(tmp_path / "none")) == {}
