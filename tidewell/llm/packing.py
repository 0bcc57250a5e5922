"""Packing items into containers of fixed capacity by a grouping genetic algorithm on islands.

Items are dealt to blocks by hash; a block is small enough for one task. Several islands evolve packings of the same
block. A crossover injects well-filled bins of one parent whole into the other, removes the bins there that hold the same
items, and places the displaced items by best fit. After each epoch every island's elite also goes to the next island.
The best packing of each block comes out. An island stops early only where its packing is proven best: as many bins as
the sum of sizes needs.
"""

from __future__ import annotations

import random
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.session import cut, parts

STATE = "block bigint, island int, item_id bigint, piece int, size int, bin int, n_bins int, score double"
Packing = list[tuple[int, tuple[int, ...]]]


#: The class of each byte of a text: 0 blank, 1 of a word, 2 other; all bytes of other characters are of class 2.
KIND = np.full(256, 2, np.uint8)
KIND[[*b" \t\r\n"]] = 0
KIND[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_"]] = 1


def _runs(texts: pa.Array) -> np.ndarray:
    """The number of runs of bytes of one class, blanks left out, in each text."""
    texts = texts.fill_null("").cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    first = int(ends[0]) if len(texts) else 0
    at = ends - first
    kind = KIND[np.frombuffer(texts.buffers()[2] or b"", np.uint8)[first : first + int(at[-1])]] if len(texts) else KIND[:0]
    begins = kind != 0
    begins[1:] &= kind[1:] != kind[:-1]
    start = at[:-1]
    within = start[start < len(kind)]
    begins[within] = kind[within] != 0  # a run doesn't go on from one text to the next
    upto = np.r_[0, np.cumsum(begins)]
    return upto[at[1:]] - upto[start]


def count_tokens(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id_col and n_tokens: the matches of ``[A-Za-z0-9_]+|[^A-Za-z0-9_ \\t\\r\\n]+``, counted on the bytes; 0 for a null text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict({id_col: batch[id_col], "n_tokens": pa.array(_runs(batch["_text"]).astype(np.int64))})

    return df.select(id_col, F.col(text_col).alias("_text")).mapInArrow(count, f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, n_tokens bigint")


def best_fit(items: Iterable[int], sizes: list[int], bins: Packing, capacity: int) -> Packing:
    """Places the items, in the given order, each into the bin with the least room that takes it."""
    full: Packing = []
    by_room: dict[int, list[tuple[int, list[int]]]] = {}
    rooms = 0  # bit r: some bin has room r
    for fill, own in bins:
        room = capacity - fill
        if room:
            by_room.setdefault(room, []).append((fill, list(own)))
            rooms |= 1 << room
        else:
            full.append((fill, own))
    for i in items:
        size = sizes[i]
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            at = by_room[room]
            fill, own = at.pop()
            if not at:
                rooms &= ~(1 << room)
        else:
            room, fill, own = capacity, 0, []
        own.append(i)
        fill, room = fill + size, room - size
        if room:
            by_room.setdefault(room, []).append((fill, own))
            rooms |= 1 << room
        else:
            full.append((fill, tuple(own)))
    full.extend((fill, tuple(own)) for at in by_room.values() for fill, own in at)
    return full


def score(bins: Packing, capacity: int) -> tuple[int, float]:
    """Fewer bins are better, then unevenly filled ones: their room is in one place."""
    return len(bins), -sum((fill / capacity) ** 2 for fill, _ in bins)


def cross(a: Packing, b: Packing, sizes: list[int], capacity: int, rng: random.Random) -> Packing:
    """Injects the fuller bins of a, from a random stretch of them, into b."""
    ranked = sorted(a, key=lambda x: -x[0])
    take = max(1, len(ranked) // 3)
    start = rng.randrange(max(1, len(ranked) - take) // 2 + 1)
    injected = ranked[start : start + take]
    held = {i for _, own in injected for i in own}
    kept, displaced = list(injected), []
    for fill, own in b:
        if held.isdisjoint(own):
            kept.append((fill, own))
        else:
            displaced.extend(i for i in own if i not in held)
    return best_fit(sorted(displaced, key=lambda i: -sizes[i]), sizes, kept, capacity)


def mutate(a: Packing, sizes: list[int], capacity: int, rng: random.Random) -> Packing:
    """Empties the least filled bins and a few others and places their items anew."""
    ranked = sorted(a, key=lambda x: x[0])
    n = max(2, len(ranked) // 20)
    out = ranked[:n]
    rest = ranked[n:]
    for _ in range(min(n, len(rest))):
        k = rng.randrange(len(rest))
        rest[k], rest[-1] = rest[-1], rest[k]
        out.append(rest.pop())
    loose = [i for _, own in out for i in own]
    loose.sort(key=lambda i: -sizes[i] * rng.uniform(0.9, 1.1))
    return best_fit(loose, sizes, rest, capacity)


def evolve(sizes: list[int], seeds: list[Packing], capacity: int, population: int, generations: int, rng: random.Random) -> Packing:
    """The best packing that an island finds from the seeds."""
    need = -(-sum(sizes) // capacity)
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    pool = list(seeds) or [best_fit(order, sizes, [], capacity)]
    best = min(pool, key=lambda x: score(x, capacity))
    if len(best) <= need:
        return best
    while len(pool) < population:
        shuffled = sorted(order, key=lambda i: -sizes[i] * rng.uniform(0.7, 1.3))
        pool.append(best_fit(shuffled, sizes, [], capacity))
    for _ in range(generations):
        a, b = rng.sample(pool, 2)
        child = cross(a, b, sizes, capacity, rng)
        if rng.random() < 0.5:
            child = mutate(child, sizes, capacity, rng)
        worst = max(range(len(pool)), key=lambda k: score(pool[k], capacity))
        if score(child, capacity) < score(pool[worst], capacity):
            pool[worst] = child
        best = min(best, child, key=lambda x: score(x, capacity))
        if len(best) <= need:
            break
    return best


def _island(capacity: int, population: int, generations: int, epoch: int):
    def run(t: pa.Table) -> pa.Table:
        block, island = t["block"][0].as_py(), t["island"][0].as_py()
        ids, pieces, sizes, froms, bins = (t[c].to_pylist() for c in ("item_id", "piece", "size", "from_island", "bin"))
        # The same item comes once from each elite; items are numbered in a fixed order, so a retried task gives the same.
        own = sorted(set(zip(ids, pieces, sizes, strict=True)))
        number = {(i, p): k for k, (i, p, _) in enumerate(own)}
        size = [s for *_, s in own]
        packs: dict[int, dict[int, list[int]]] = {}
        for i, p, f, b in zip(ids, pieces, froms, bins, strict=True):
            if b is not None:
                packs.setdefault(f, {}).setdefault(b, []).append(number[i, p])
        seeds = [[(sum(size[k] for k in sorted(x)), tuple(sorted(x))) for _, x in sorted(pack.items())] for _, pack in sorted(packs.items())]
        rng = random.Random(f"{block}/{island}/{epoch}")
        best = evolve(size, seeds, capacity, population, generations, rng)
        at = [0] * len(own)
        for k, (_, members) in enumerate(best):
            for i in members:
                at[i] = k
        n, s = score(best, capacity)
        return pa.table({
            "block": pa.array([block] * len(own), pa.int64()), "island": pa.array([island] * len(own), pa.int32()), "item_id": pa.array([i for i, *_ in own], pa.int64()), "piece": pa.array([p for _, p, _ in own], pa.int32()),
            "size": pa.array(size, pa.int32()), "bin": pa.array(at, pa.int32()), "n_bins": pa.array([n] * len(own), pa.int32()), "score": pa.array([s] * len(own), pa.float64()),
        })

    return run


def pack(df: DataFrame, id_col: str, size: Column, capacity: int, *, block_items: int = 4096, islands: int = 3, epochs: int = 2, population: int = 6, generations: int = 12) -> DataFrame:
    """item_id, piece, n_pieces, size, container: every piece of every item and the container that it is in.

    An item above the capacity is split into full pieces and a rest, and no other is; pieces count from 0, a full piece
    is a container of its own. Items of size 0, of a null size or a null id take no room and are left out; repeated rows
    of an id count once, at their greatest size. An empty table gives an empty result. A container's number is unique in
    the result. ``block_items`` bounds what one task packs: a block leaves one badly filled container at most.
    """
    items = df.select(F.col(id_col).cast("bigint").alias("item_id"), size.cast("bigint").alias("total")).filter("item_id IS NOT NULL AND total > 0")
    items = cut(items.groupBy("item_id").agg(F.max("total").alias("total")).withColumn("n_pieces", F.ceil(F.col("total") / capacity).cast("int")))
    rest = F.col("total") - (F.col("n_pieces") - 1) * F.lit(capacity)
    # Full pieces need no packing, so an item, however large, brings one piece to its block at most.
    n_full = F.when(rest == capacity, F.col("n_pieces")).otherwise(F.col("n_pieces") - 1)
    whole = items.filter(n_full > 0).select("item_id", F.explode(F.sequence(F.lit(0), n_full - 1)).alias("piece"), "n_pieces", F.lit(capacity).alias("size"))
    whole = whole.withColumn("container", F.concat_ws("-", F.lit("full"), "item_id", "piece"))
    pieces = items.filter(rest < capacity).select("item_id", (F.col("n_pieces") - 1).alias("piece"), rest.cast("int").alias("size"))
    blocks = parts(max(1, items.count()), block_items)
    keyed = pieces.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    state = keyed.select("block", F.explode(F.array(*[F.lit(k) for k in range(islands)])).alias("island"), "item_id", "piece", "size", F.lit(-1).alias("from_island"), F.lit(None).cast("int").alias("bin"))
    for epoch in range(epochs):
        best = state.groupBy("block", "island").applyInArrow(_island(capacity, population, generations, epoch), STATE)
        if epoch < epochs - 1:
            to = F.explode(F.array_distinct(F.array(F.col("island"), (F.col("island") + 1) % islands))).alias("to")
            state = best.select("block", to, "item_id", "piece", "size", F.col("island").alias("from_island"), "bin").withColumnRenamed("to", "island")
    first = Window.partitionBy("block")
    winner = best.withColumn("_best", F.min(F.struct("n_bins", "score", "island")).over(first)).filter("island = _best.island")
    packed = winner.select("item_id", "piece", (F.col("piece") + 1).alias("n_pieces"), "size", F.concat_ws("-", "block", "bin").alias("container"))
    return packed.unionByName(whole)
