import random

import pytest
from conftest import rows

from tidewell.operators import hierarchy as module
from tidewell.operators.hierarchy import descendants, hierarchy

SCHEMA = "id string, parent_id string, link_id string, path int, component string"


def brute(table):
    links = {}
    for i, p, link, *_ in table:
        if i is not None:
            norm = lambda x: None if x is None else x.strip().lower()
            links.setdefault(i, (norm(p), norm(link)))
    out = {}
    for i in links:
        path, at, end = [i], i, None
        while True:
            p = links[at][0]
            if p is not None and p.startswith("t3_"):
                end = p
                break
            q = p[3:] if p is not None and p.startswith("t1_") else p
            if q is None or q not in links:
                end = ""
                break
            if q in path:
                end = ("ring", path[path.index(q) :])
                path_to = path[: path.index(q)]
                break
            path.append(q)
            at = q
        if end == "":
            out[i] = ("lost", path[-1], len(path) - 1, tuple(reversed(path)))
        elif isinstance(end, str):
            out[i] = (None if end == links[i][1] else "wrong_root", end, len(path), (end, *reversed(path)))
        elif i in end[1]:
            out[i] = ("cycle", None, None, (i,))
        else:
            out[i] = ("to_cycle", None, None, (end[1][0], *reversed(path_to)))
    return out


def forest(n, seed):
    r = random.Random(seed)
    t = []
    for i in range(n):
        x = r.random()
        link = f"t3_s{r.randrange(4)}"
        p = f"t3_s{r.randrange(4)}" if x < 0.15 else None if x < 0.18 else "t1_gone" if x < 0.2 else f" T1_{'N'}{r.randrange(n)}" if x < 0.3 else f"t1_n{r.randrange(max(1, i))}"
        t.append((f"n{i}", p, link, 1, "clash"))
        if x > 0.9:
            t.append(t[-1])
    return t


@pytest.mark.parametrize("how", [{}, {"rows_per_task": 40}, {"rows_per_task": 30, "max_component": 5}])
def test_as_brute_force(spark, how):
    t = [*forest(120, 3), (None, "t3_a", None, None, None), ("self", "t1_self", "t3_a", 0, ""), ("a", "t1_b", "t3_a", 0, ""), ("b", "t1_a", "t3_a", 0, ""), ("c", "t1_b", "t3_a", 0, ""), ("nolink", "t3_a", None, 0, "")]
    got = hierarchy(spark.createDataFrame(t, SCHEMA), **how)
    want = brute(t)
    assert {r.id: (r.state, r.root, r.depth, tuple(r.path)) for r in got.collect()} == want
    pairs = {(r.ancestor, r.descendant) for r in descendants(got).collect()}
    for r in got.filter("state != 'cycle' OR state IS NULL").collect():
        assert r.n_descendants == sum(a == r.id for a, _ in pairs)
    plain = hierarchy(spark.createDataFrame(t, SCHEMA), with_path=False, **how)
    assert rows(plain, "id", "state", "back_edge") == rows(got, "id", "state", "back_edge")
    assert {r.id for r in got.filter("back_edge").collect()} >= {"self", "a"}


def test_long_chain_and_empty(spark):
    n = 2000
    chain = [(f"c{i}", "t3_top" if i == 0 else f"t1_c{i - 1}", "t3_top", 0, "") for i in range(n)]
    for how in ({}, {"max_component": 10, "rows_per_task": 1000}):
        got = hierarchy(spark.createDataFrame(chain, SCHEMA), with_path=False, **how)
        assert got.filter("state IS NULL AND root = 't3_top'").count() == n
        assert got.agg({"depth": "max"}).first()[0] == n
    assert hierarchy(spark.createDataFrame([], SCHEMA)).count() == 0


def all_pairs(table):
    """(ancestor, descendant, distance), by walking up from each node until nothing new is met."""
    up = {}
    for i, p, *_ in table:
        if i is not None:
            up[i] = p and p.strip().lower()
    out = []
    for i in up:
        at, met, n = i, set(), 0
        while True:
            p = up[at]
            q = p[3:] if p and p.startswith("t1_") else p
            if q is None or q in met or not (q in up or q.startswith("t3_")):
                break
            n += 1
            met.add(q)
            out.append((q, i, n))
            if q.startswith("t3_"):
                break
            at = q
    return out


@pytest.mark.parametrize("broadcast", [50_000, 0])
@pytest.mark.parametrize("how", [{}, {"rows_per_task": 40}, {"rows_per_task": 30, "max_component": 5}])
def test_descendants_on_and_below_cycles(spark, monkeypatch, how, broadcast):
    monkeypatch.setattr(module, "BROADCAST_ROWS", broadcast)
    t = [*forest(60, 3), ("self", "t1_self", "t3_a", 0, ""), ("under", "t1_self", "t3_a", 0, ""), ("a", "t1_b", "t3_a", 0, ""), ("b", "t1_a", "t3_a", 0, ""), ("c", "t1_a", "t3_a", 0, "")]
    t += [(f"r{i}", f" T1_R{(i + 4) % 7} ", "t3_a", 0, "") for i in range(7)] + [("h0", "t1_r5", "t3_a", 0, ""), ("h1", "t1_h0", "t3_a", 0, ""), ("h2", "t1_r2", "t3_a", 0, "")]
    got = hierarchy(spark.createDataFrame(t, SCHEMA), **how)
    pairs = [tuple(r) for r in descendants(got).select("ancestor", "descendant", "distance").collect()]
    assert sorted(pairs) == sorted(all_pairs(t))
    assert {("b", "a", 1), ("a", "b", 1), ("b", "c", 2), ("a", "a", 2), ("self", "self", 1)} <= set(pairs)
    for r in got.collect():
        assert r.n_descendants == sum(a == r.id for a, *_ in pairs)


def test_paths_are_given_out_in_bounded_batches(monkeypatch):
    import pyarrow as pa

    import tidewell.operators.hierarchy as h

    monkeypatch.setattr(h, "PATH_STEPS", 100)
    n = 400
    ids = pa.array([f"c{k}" for k in range(n)])
    parent = pa.array([None, *(f"c{k}" for k in range(n - 1))])
    got = list(h._traverse(ids, parent, ["t3_x"] + [None] * (n - 1), ["t3_x"] * n, ["c0"] * n, True))
    paths = {r["id"]: r["path"] for b in got for r in b.to_pylist()}
    assert paths == {f"c{k}": ["t3_x", *(f"c{j}" for j in range(k + 1))] for k in range(n)}
    assert max(sum(len(p) for p in b["path"].to_pylist()) for b in got) <= 100 + n + 1
