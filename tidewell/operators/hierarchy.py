"""Hierarchies of unknown depth from parent-child rows.

Each node has at most one parent, so the links form trees and, where they are wrong, cycles with trees hanging on them.

1. Connected components. Rows are range-partitioned by (root reference, id), which balances partitions and splits a hot
   root between them; each partition contracts its own links to local components. Only links that leave a partition
   remain, one per local component at most, and this much smaller graph of components is contracted again.
2. Components are co-located, and an iterative depth-first traversal with node colouring runs over each.
3. Components above ``max_component`` nodes never go to one task: their paths come from pointer doubling instead.

Nulls: a null id names no node and is dropped; a null parent ends a path (``lost``). Repeated rows of an id count once
(the least parent and root reference hold). An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.functions.reading import reference
from tidewell.operators.skewed import join_hot
from tidewell.session import cut, parts

LOCAL = "id string, parent string, top string, link string, part_label string, away boolean"
#: Steps of paths that a task holds at a time; a longer path is held alone.
PATH_STEPS = 200_000
#: Cycle nodes sent to every executor at most; more are joined by a shuffle of so many salts.
BROADCAST_ROWS, SALTS = 50_000, 16
SCHEMA = "id string, state string, root string, depth int, back_edge boolean, component string"


def _whole(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    got = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(got).combine_chunks() if got else None


def _flat(t: pa.Table, name: str) -> pa.Array:
    col = t.column(name)
    return col.chunk(0) if col.num_chunks == 1 else pa.concat_arrays(col.chunks)


def _labels(to: np.ndarray) -> np.ndarray:
    """The component of each node of the graph i -> to[i] (-1: no link), as the index of its root or least cycle node."""
    at = np.where(to < 0, np.arange(len(to)), to)
    least = np.minimum(np.arange(len(to)), at)
    for _ in range(max(1, int(len(to)).bit_length())):
        nxt = at[at]
        if np.array_equal(nxt, at):
            break
        least = np.minimum(least, least[at])
        at = nxt
    return least[at]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    t = _whole(batches)
    if t is None:
        return
    ids, parent = _flat(t, "id"), _flat(t, "parent")
    to = pc.fill_null(pc.index_in(parent, value_set=ids, skip_nulls=True), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    label = ids.take(pa.array(_labels(to)))
    away = pc.and_(pc.is_valid(parent), pa.array(to < 0))
    out = pa.table({"id": ids, "parent": parent, "top": t["top"], "link": t["link"], "part_label": label, "away": away})
    yield from out.to_batches(max_chunksize=50_000)


def _relabel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Contracts the graph of local components when it fits one task."""
    t = _whole(batches)
    if t is None:
        return
    names = pc.unique(pa.concat_arrays([_flat(t, "a"), _flat(t, "b")]))
    to = np.full(len(names), -1, dtype=np.int64)
    to[pc.index_in(t["a"], value_set=names).to_numpy()] = pc.index_in(t["b"], value_set=names).to_numpy()
    yield from pa.table({"part_label": names, "component": names.take(pa.array(_labels(to)))}).to_batches(max_chunksize=50_000)


def _doubled_labels(edges: DataFrame, n: int) -> DataFrame:
    """The same for any number of links a -> b: jump pointers over twice the distance in each round."""
    nodes = edges.select(F.col("a").alias("n")).union(edges.select("b")).distinct()
    state = cut(nodes.join(edges, nodes.n == edges.a, "left").select("n", F.coalesce("b", "n").alias("f"), F.least("n", F.coalesce("b", "n")).alias("m")))
    for _ in range(max(1, (2 * n).bit_length())):
        far = state.select(F.col("n").alias("f"), F.col("f").alias("ff"), F.col("m").alias("fm"))
        new = cut(join_hot(state, far, ["f"]).select("n", F.col("ff").alias("f"), F.least("m", "fm").alias("m"), (F.col("ff") != F.col("f")).alias("moved")))
        state = new.drop("moved")
        if new.filter("moved").isEmpty():
            break
    end = state.select(F.col("n").alias("f"), F.col("m").alias("component"))
    return join_hot(state, end, ["f"]).select(F.col("n").alias("part_label"), "component")


def _traverse(ids: pa.Array, parent: pa.Array, top: list, link: list, comp: list, with_path: bool) -> Iterator[pa.RecordBatch]:
    """Depth-first over the nodes of whole components; white 0, grey 1, black 2."""
    n = len(ids)
    up = pc.fill_null(pc.index_in(parent, value_set=ids, skip_nulls=True), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    order = np.argsort(up, kind="stable")
    first = np.searchsorted(up[order], np.arange(n), side="left").tolist()
    last = np.searchsorted(up[order], np.arange(n), side="right").tolist()
    order, above = order.tolist(), up.tolist()
    names = ids.to_pylist()
    colour = bytearray(n)
    depth, root, state = [None] * n, [None] * n, [None] * n
    back = bytearray(n)
    ring_at: list = [None] * n
    below = [0] * n
    starts = [(i, "tree") for i in range(n) if above[i] < 0]
    for s in range(n):  # the rest: walk up until a grey node closes a cycle
        if above[s] < 0 or colour[s]:
            continue
        seen, i = [], s
        while i >= 0 and not colour[i]:
            colour[i] = 1
            seen.append(i)
            i = above[i]
        if i >= 0 and colour[i] == 1:
            ring = seen[seen.index(i) :]
            for k in ring:
                state[k] = "cycle"
                starts.append((k, "ring"))
            least = min(range(len(ring)), key=lambda j: names[ring[j]])
            back[ring[least]] = 1
            for j, k in enumerate(ring):
                ring_at[k] = (least - j) % len(ring)
        for k in seen:
            colour[k] = 2
    colour = bytearray(n)
    for s, kind in starts:
        if kind == "ring":
            broken, r, d = "to_cycle", None, None
        elif top[s] is not None:
            broken, r, d = None, top[s], 1
        else:
            broken, r, d = "lost", names[s], 0
        stack = [s]
        root[s], depth[s] = r, d
        while stack:
            i = stack[-1]
            if not colour[i]:
                colour[i] = 1
                if state[i] is None:
                    state[i] = broken or (None if r == link[i] else "wrong_root")
                deeper = depth[i] + 1 if d is not None else None
                for k in order[first[i] : last[i]]:
                    if state[k] != "cycle":
                        root[k], depth[k], ring_at[k] = r, deeper, ring_at[i]
                        stack.append(k)
            else:
                stack.pop()
                if colour[i] == 1:
                    colour[i] = 2
                    if above[i] >= 0 and state[i] != "cycle":
                        below[above[i]] += below[i] + 1
    ring_size: dict = {}
    if with_path:  # every node that hangs on a cycle, and the cycle's own, is below each cycle node
        for i in range(n):
            if state[i] == "cycle":
                ring_size[comp[i]] = ring_size.get(comp[i], 0) + below[i] + 1
        for i in range(n):
            if state[i] == "cycle":
                below[i] = ring_size[comp[i]]
    out = {"id": ids, "state": pa.array(state, pa.string()), "root": pa.array(root, pa.string()), "depth": pa.array(depth, pa.int32()), "back_edge": pa.array(np.frombuffer(back, np.uint8).astype(bool)), "component": pa.array(comp, pa.string())}
    if not with_path:
        yield from pa.table(out).to_batches(max_chunksize=20_000)
        return
    whole = pa.table(out | {"n_descendants": pa.array(below, pa.int64()), "ring_at": pa.array(ring_at, pa.int32())})
    pool = pa.concat_arrays([ids, pa.array(top, pa.string())])  # a root reference has the number of its node, moved on by n
    heads = [(s, kind != "ring" and top[s] is not None) for s, kind in starts]
    for nodes, ends, steps in _paths(heads, n, order, first, last, state):
        t = whole.take(pa.array(nodes))
        path = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(ends)].astype(np.int32)), pool.take(pa.array(steps)))
        yield from t.add_column(6, "path", path).combine_chunks().to_batches()


def _paths(heads: list[tuple[int, bool]], n: int, order: list, first: list, last: list, state: list) -> Iterator[tuple[list, list, np.ndarray]]:
    """(nodes, lengths of their paths, the paths one after another), PATH_STEPS steps or one node at a time.

    Only the walk from the head to the node at hand is kept: paths are copied from it as they are given out.
    """
    walk = np.zeros(1024, dtype=np.int64)
    nodes, lengths, steps, held = [], [], [], 0
    for head, has_root in heads:
        walk[0] = head + n
        stack = [(head, int(has_root))]
        while stack:
            i, d = stack.pop()
            if d >= len(walk):
                walk = np.r_[walk, np.zeros(len(walk), dtype=np.int64)]
            walk[d] = i
            nodes.append(i)
            lengths.append(d + 1)
            steps.append(walk[: d + 1].copy())
            held += d + 1
            if held >= PATH_STEPS:
                yield nodes, lengths, np.concatenate(steps)
                nodes, lengths, steps, held = [], [], [], 0
            stack.extend((k, d + 1) for k in order[first[i] : last[i]] if state[k] != "cycle")
    if nodes:
        yield nodes, lengths, np.concatenate(steps)


def _walker(with_path: bool):
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _whole(batches)
        if t is not None:
            yield from _traverse(_flat(t, "id"), _flat(t, "parent"), t["top"].to_pylist(), t["link"].to_pylist(), t["component"].to_pylist(), with_path)

    return walk


RING = "\0ring"
KEPT = [*(c.split()[0] for c in SCHEMA.split(", ")), "path", "n_descendants", "ring_at"]


def _jumps(nodes: DataFrame, n: int, with_path: bool) -> DataFrame:
    """Pointers of doubling length. ``stop`` says how a path ends: a root reference, '' (lost) or RING; null: in a cycle or on the way to one."""
    state = cut(nodes.select("id", "component", "link", "stop", F.when(F.col("stop").isNull(), F.col("parent")).alias("f"), F.lit(1).alias("hops"), F.when(F.col("stop").isNotNull(), F.col("id")).alias("end"), *([F.array("id").alias("path")] if with_path else [])))
    image = -1
    for _ in range(n.bit_length() + 1):
        far = state.select(F.col("id").alias("f"), F.col("f").alias("ff"), F.col("stop").alias("fstop"), F.col("hops").alias("fhops"), F.col("end").alias("fend"), *([F.col("path").alias("fpath")] if with_path else []))
        go = F.col("f").isNotNull()  # nodes whose path has ended have no f, and join_hot keeps their key apart
        path = [F.when(go, F.concat("fpath", "path")).otherwise(F.col("path")).alias("path")] if with_path else []
        state = cut(join_hot(state, far, ["f"], "left").select("id", "component", "link", F.coalesce("stop", "fstop").alias("stop"), F.col("ff").alias("f"), F.when(go, F.least(F.col("hops").cast("bigint") + F.col("fhops"), F.lit(2**30)).cast("int")).otherwise(F.col("hops")).alias("hops"), F.coalesce("end", "fend").alias("end"), *path))
        now = state.filter("f IS NOT NULL").agg(F.countDistinct("f")).first()[0]
        if now == 0 or now == image:  # all paths ended, or what is left only turns in its cycles
            break
        image = now
    return state


def _large(nodes: DataFrame, n: int, with_path: bool) -> DataFrame:
    """Results for components that are too large for one task."""
    known = nodes.select(F.col("id").alias("parent"), F.lit(True).alias("there"))
    nodes = cut(join_hot(cut(nodes), known, ["parent"], "left").withColumn("stop", F.when(F.col("there"), None).otherwise(F.coalesce("top", F.lit("")))).drop("there"))
    state = _jumps(nodes, n, False)
    ring = cut(state.filter("f IS NOT NULL").select("component", F.col("f").alias("id")).distinct())
    if with_path or not ring.isEmpty():
        on = ring.select("id", F.lit(RING).alias("ring"))
        state = _jumps(nodes.join(on, "id", "left").withColumn("stop", F.coalesce("ring", "stop")).drop("ring"), n, with_path)
    least = ring.groupBy("component").agg(F.min("id").alias("least"))
    state = state.join(least, "component", "left")
    ended = F.col("stop") != RING
    out = state.select(
        "id",
        F.when((F.col("stop") == RING) & (F.col("end") == F.col("id")), "cycle").when(F.col("stop") == RING, "to_cycle").when(F.col("stop") == "", "lost").when(~F.col("stop").eqNullSafe(F.col("link")), "wrong_root").alias("state"),
        F.when(ended, F.when(F.col("stop") == "", F.col("end")).otherwise(F.col("stop"))).alias("root"),
        F.when(ended, F.col("hops") - F.when(F.col("stop") == "", 1).otherwise(0)).cast("int").alias("depth"),
        (F.col("id") == F.col("least")).eqNullSafe(F.lit(True)).alias("back_edge"),
        "component",
        *([F.when(ended & (F.col("stop") != ""), F.concat(F.array("stop"), "path")).otherwise(F.col("path")).alias("path")] if with_path else []),
    )
    if not with_path:
        return out
    at = _jumps(nodes.join(ring.select("id"), "id", "left_semi").join(least.select(F.col("least").alias("id"), F.lit(RING).alias("ring")), "id", "left").withColumn("stop", F.col("ring")).drop("ring"), n, False)
    at = at.select(F.col("id").alias("entry"), (F.col("hops") - 1).alias("ring_at"))
    out = out.withColumn("entry", F.when(F.col("state").isin("cycle", "to_cycle"), F.element_at("path", 1))).join(at, "entry", "left").drop("entry")
    below = out.select("state", F.explode("path").alias("up"), "id").filter("up != id").groupBy("up").agg(F.count("*").alias("n_below"))
    total = out.groupBy("component").agg(F.count("*").alias("n_all"))
    out = out.join(below.withColumnRenamed("up", "id"), "id", "left").join(total, "component", "left")
    return out.withColumn("n_descendants", F.when(F.col("state") == "cycle", F.col("n_all")).otherwise(F.coalesce("n_below", F.lit(0))).cast("bigint")).select(*KEPT)


def hierarchy(df: DataFrame, id_col: str = "id", parent_col: str = "parent_id", link_col: str = "link_id", *, node_prefix: str = "t1_", root_prefix: str = "t3_", with_path: bool = True, rows_per_task: int = 150_000, max_component: int = 200_000) -> DataFrame:
    """One row per node: id, state, root, depth, back_edge, component and, with_path, path, n_descendants and ring_at.

    A parent reference is a prefix and an id: ``node_prefix`` names another node, ``root_prefix`` a root outside the table.
    state: null (sound), ``cycle`` (on a cycle), ``to_cycle`` (its path leads into one), ``lost`` (the path ends at a null
    or unknown parent) or ``wrong_root`` (it reaches another root than the row's own ``link_col``, or the row has none).
    root: the root reference reached; of a lost path its topmost node; null with cycles, as is depth. depth: links to the
    root. back_edge: on each cycle the node with the least id, whose parent link closes it. path: from the root to the
    node, ends included; with cycles from the cycle node at which the path enters. n_descendants: nodes below; a cycle's
    nodes are below each other and themselves. ring_at: links from the node, or from the cycle node at which its path
    enters, along the cycle to its back_edge node; null without a cycle. ``rows_per_task`` and ``max_component`` bound what one task holds.
    """
    ref = reference(parent_col)
    rows = df.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), ref.alias("p"), reference(link_col).alias("link"))
    rows = rows.groupBy("id").agg(F.min("p").alias("p"), F.min("link").alias("link"))
    is_top = F.col("p").startswith(root_prefix)
    rows = rows.select("id", F.when(F.col("p").startswith(node_prefix), F.expr(f"substring(p, {len(node_prefix) + 1})")).when(~is_top, F.col("p")).alias("parent"), F.when(is_top, F.col("p")).alias("top"), "link")
    n_rows = df.count()
    spread = parts(n_rows, rows_per_task)
    nodes = cut(rows.repartitionByRange(spread, "link", "id").mapInArrow(_contract, LOCAL))

    away = nodes.filter("away").select(F.col("part_label").alias("a"), F.col("parent").alias("id"))
    edges = cut(join_hot(away, nodes.select("id", F.col("part_label").alias("b")), ["id"]).select("a", "b"))
    n_edges = edges.count()
    if n_edges:
        if n_edges <= rows_per_task:
            moved = edges.coalesce(1).mapInArrow(_relabel, "part_label string, component string")
        else:
            moved = _doubled_labels(edges, n_edges)
        nodes = nodes.join(moved, "part_label", "left").withColumn("component", F.coalesce("component", "part_label"))
    else:
        nodes = nodes.withColumn("component", F.col("part_label"))
    nodes = nodes.select("id", "parent", "top", "link", "component")
    schema = SCHEMA + (", path array<string>, n_descendants bigint, ring_at int" if with_path else "")
    if n_rows <= max_component:
        return nodes.repartition(spread, "component").mapInArrow(_walker(with_path), schema)
    nodes = cut(nodes)
    large = nodes.groupBy("component").count().filter(F.col("count") > max_component).select("component", F.lit(True).alias("large"))
    large = cut(large)  # at most n_rows / max_component rows
    n_large = large.count()
    if not n_large:
        return nodes.repartition(spread, "component").mapInArrow(_walker(with_path), schema)
    # The table of large components has at most n_rows / max_component rows; as a broadcast it stays under 10,000 of them.
    marked = nodes.join(F.broadcast(large) if n_large <= 10_000 else large, "component", "left")
    small = marked.filter("large IS NULL").drop("large").repartition(spread, "component").mapInArrow(_walker(with_path), schema)
    big = _large(marked.filter("large").drop("large"), n_rows, with_path)
    return small.unionByName(big)


def descendants(nodes: DataFrame) -> DataFrame:
    """All (ancestor, descendant, distance) from the result of :func:`hierarchy` with paths.

    Ancestors include the root reference. Every node that is on a cycle or hangs on it is below each of the cycle's nodes,
    a cycle's node also below itself. distance: parent links from the descendant until the ancestor is first reached, at
    least 1, so that of a cycle's node to itself is the cycle's length. A node has as many pairs as n_descendants says.
    """
    along = nodes.select(F.col("id").alias("descendant"), F.posexplode("path").alias("at", "ancestor"), F.size("path").alias("n")).select("ancestor", "descendant", (F.col("n") - 1 - F.col("at")).alias("distance")).filter("distance > 0")
    hung = cut(nodes.filter("state IN ('cycle', 'to_cycle')").select("component", F.col("id").alias("descendant"), "state", "ring_at", (F.size("path") - 1).alias("hops")))
    ring = hung.filter("state = 'cycle'").select("component", F.col("descendant").alias("ancestor"), F.col("ring_at").alias("at"))
    ring = ring.join(ring.groupBy("component").agg(F.count("*").cast("int").alias("length")), "component")
    n_ring = ring.count()
    if not n_ring:
        return along
    below = hung.select("component", "descendant", "ring_at", "hops")
    if n_ring <= BROADCAST_ROWS:
        both = below.join(F.broadcast(ring), "component")
    else:  # a cycle may have any number of nodes below it: they are spread over salts
        salted = ring.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        both = below.withColumn("salt", F.pmod(F.xxhash64("descendant"), F.lit(SALTS)).cast("int")).join(salted, ["component", "salt"])
    round_ = F.pmod(F.col("ring_at") - F.col("at"), F.col("length"))
    far = F.col("hops") + F.when((F.col("hops") == 0) & (round_ == 0), F.col("length")).otherwise(round_)
    # The path of a node that hangs on a cycle begins with the cycle's node at which it enters: that pair is there already.
    around = both.filter((F.col("hops") == 0) | (round_ != 0)).select("ancestor", "descendant", far.cast("int").alias("distance"))
    return along.unionByName(around)
