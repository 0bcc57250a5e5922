"""The overflow of whole lines of both main tables, against the extra_json that went in."""

import json
from collections import Counter
from pathlib import Path

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"
ODD = ['{"k":1}', ' { "k" : {"a": [1, 2.50, null]}, "l": null } ', "{}", '{"k":1', '{"k":1}}', '{"k":1},{"l":2}', '"{\\"k\\":1}"', "[1]", "5", "null", "", "{'k':1}", '{"k":NaN}', None]


def loads(text):
    """Strictly, and numbers by value: the overflow is canonical, 1.0 as 1."""
    return json.loads(text, parse_constant=lambda x: 1 / 0, parse_float=lambda x: int(float(x)) if float(x).is_integer() else float(x))


def expected(extra):
    """The unknown fields of a line: those of an object, or the text itself where it is none; null if there are none."""
    if extra is None:
        return None
    try:
        x = loads(extra)
    except (ValueError, ZeroDivisionError):
        x = None
    x = x if isinstance(x, dict) else {"extra_json": extra}
    return json.dumps(x, sort_keys=True) if x else None


def same(df, back):
    """Rows with all their columns, extra_json by what it holds."""
    names = [c for c in back.columns if c != "extra_json"]
    row = lambda r, f: (*(r[c] for c in names), f(r["extra_json"]))
    was = Counter(row(r, expected) for r in df.select(*names, "extra_json").collect())
    got = Counter(row(r, lambda x: x and json.dumps(loads(x), sort_keys=True)) for r in back.collect())
    assert got == was
    return sum(n for r, n in was.items() if r[-1] is not None)


@pytest.mark.parametrize("kind", ["rc", "rs"])
def test_overflow_of_tables(spark, kind):
    if not Path(SF).exists():
        pytest.skip("no test tables here")
    back = entry.queries()[f"normalize_{kind}_overflow"](spark, SF)
    assert same(spark.read.parquet(f"{SF}/master_schema_{kind}.parquet"), back) > 100


@pytest.mark.parametrize("kind", ["rc", "rs"])
def test_odd_texts(spark, tmp_path, kind):
    some = spark.read.parquet(f"{SF}/master_schema_{kind}.parquet").limit(1).drop("extra_json")
    odd = spark.createDataFrame([(x,) for x in ODD], "extra_json string")
    some.crossJoin(odd).write.parquet(f"{tmp_path}/master_schema_{kind}.parquet")
    back = entry.queries()[f"normalize_{kind}_overflow"](spark, str(tmp_path))
    assert back.count() == len(ODD)
    assert same(spark.read.parquet(f"{tmp_path}/master_schema_{kind}.parquet"), back) == len(ODD) - 2
