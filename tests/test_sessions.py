import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidewell.operators.sessions import dilate, runs, sessions, shift_up

SCHEMA = "author string, t bigint, id string, entity int, n bigint"


def brute(table, gap):
    by = {}
    for a, t, i, *_ in table:
        if None not in (a, t, i):
            by.setdefault(a, {}).setdefault(i, []).append(t)
    out = []
    for a, ids in by.items():
        ts = sorted(min(x) for x in ids.values())
        start = prev = ts[0]
        n = 0
        for t in ts:
            if t - prev > gap:
                out.append((a, start, prev, prev - start, n))
                start, n = t, 0
            prev, n = t, n + 1
        out.append((a, start, prev, prev - start, n))
    return sorted(out, key=repr)


def test_bitmaps():
    x = np.zeros(4, np.uint64)
    x[0] = 1
    for s in (0, 1, 63, 64, 65, 130, 255):
        assert np.flatnonzero(np.unpackbits(shift_up(x, s).view(np.uint8), bitorder="little")).tolist() == [s]
    for length in (1, 2, 3, 7, 64, 100):
        assert np.flatnonzero(np.unpackbits(dilate(x, length).view(np.uint8), bitorder="little")).tolist() == list(range(length))
    start, end = runs(np.array([0, 5, 10, 16, 40]), 50, 5)
    assert start.tolist() == [0, 16, 40] and end.tolist() == [10, 16, 40]


@pytest.mark.parametrize(("gap", "block"), [(1800, 14_400), (7, 10), (1, 1), (50, 50)])
def test_as_brute_force(spark, gap, block):
    r = random.Random(gap)
    t = [(f"a{r.randrange(6)}", r.choice([r.randrange(20 * gap), -r.randrange(9 * gap), 5 * gap * r.randrange(40) + r.randrange(3)]), f"i{k}", 0, 1) for k in range(300)]
    t += t[:20] + [("hot", gap * k, f"h{k}", 0, 1) for k in range(200)] + [("edge", block * k, f"e{k}", 0, 1) for k in range(-3, 4)]
    t += [(None, 1, "x", 0, 1), ("z", None, "x", 0, 1), ("z", 1, None, 0, 1), ("", 3, "q", 0, 1), ("same", 9, "s1", 0, 1), ("same", 9, "s2", 0, 1)]
    got = sessions(spark.createDataFrame(t, SCHEMA).repartition(3), F.col("author"), F.col("t"), F.col("id"), gap=gap, block=block)
    assert rows(got) == brute(t, gap)


def test_empty_and_wrong(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert sessions(empty, F.col("author"), F.col("t"), F.col("id")).count() == 0
    with pytest.raises(ValueError):
        sessions(empty, F.col("author"), F.col("t"), F.col("id"), gap=10, block=5)
