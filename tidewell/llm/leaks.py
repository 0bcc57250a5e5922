"""Passages of test items inside a corpus, whole or with a few edits: pigeonhole matching.

A passage of ``window`` words with at most ``budget`` edits between item and document leaves one of any budget + 1
disjoint pieces of it intact.

1. Items are cut into aligned pieces so short that every passage holds budget + 1 of them. The rest of a passage around an
   intact piece has budget edits at most in turn, so one of the smaller pieces beside it stands intact too, moved by at
   most as many words: piece and neighbour together are a key.
2. Bitmaps of the hashes of pieces and keys, of bounded size whatever their number, are all that is sent to the executors;
   documents are read once, and where one may have a key the words around are kept. Keys join documents with items, so a
   common phrase that many items have meets only those that go on alike. Equal surroundings are one row, on both sides.
3. Every pair that the join gives is verified by Myers' bit-parallel edit distance, of each passage of the item around the
   piece against the document's words there; there is no other way to a result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators.skewed import join_hot
from tidewell.session import cut

WORD = re.compile(r"[^\W_]+")
#: Bits of the map of pieces, as a power of two: about 16 for each piece, within these bounds (8 KB and 16 MB).
LEAST_BITS, MOST_BITS = 16, 27
#: Words that a task remembers the hashes of; more are hashed again.
KNOWN_WORDS = 1_000_000
#: Pairs of passages that a task compares at a time.
PASS_PAIRS = 20_000
MULT = np.uint64(0xD6E8FEB86659FD93)
PLACES = "h bigint, item_id bigint, at int, left string, right string, keys array<bigint>"
HITS = "h bigint, doc_id bigint, at int, left string, right string, keys array<bigint>"
FOUND = "distance int, item_word int, doc_word int"


def words_of(text: str) -> list[str]:
    """The longest runs of letters or digits, in lower case."""
    return " ".join(WORD.findall(text)).lower().split(" ") if text else []


def myers(pattern: np.ndarray, text: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least edit distance of the whole pattern to any stretch of the text, end of the first such stretch), row by row.

    Myers' bit vectors over any alphabet, one bit for each of up to 63 places of the pattern, all rows in step. ``n``
    are the lengths of the rows of ``text``; what is beyond them doesn't count.
    """
    rows, m = pattern.shape
    one = np.uint64(1)
    mask, top = np.uint64((1 << m) - 1), np.uint64(m - 1)
    bit = one << np.arange(m, dtype=np.uint64)
    pv, mv = np.full(rows, mask), np.zeros(rows, np.uint64)
    dist = np.full(rows, m, dtype=np.int64)
    best, where = dist.copy(), np.zeros(rows, np.int64)
    for j in range(text.shape[1]):
        eq = ((pattern == text[:, j, None]) * bit).sum(axis=1, dtype=np.uint64)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | (~(xh | pv) & mask), pv & xh
        dist += ((ph >> top) & one).astype(np.int64) - ((mh >> top) & one).astype(np.int64)
        ph, mh = (ph << one) & mask, (mh << one) & mask
        pv, mv = mh | (~(xv | ph) & mask), ph & xv
        better = (dist < best) & (j < n)
        best[better], where[better] = dist[better], j + 1
    return best, where


class Pieces:
    """The lengths that follow from window and budget, and the hashes of pieces."""

    def __init__(self, window: int, budget: int):
        self.window, self.budget, self.compare = window, budget, myers
        self.piece = (window + 1) // (budget + 2)
        if self.piece < 1 or budget < 0 or window > 63:
            raise ValueError("the budget leaves no piece, or the window is above 63")
        # Of the rest's words, split in any way by the piece, budget + 1 neighbours of this length must be whole.
        rest = window - self.piece
        self.beside = -(-(rest + 2) // (budget + 2)) - 1
        self.sides = [(side, j) for side in (0, 1) for j in range(rest // self.beside)] if self.beside > 0 else []
        self._known: dict[str, int] = {}

    def numbers(self, words: list[str]) -> np.ndarray:
        """A hash of each word."""
        known = self._known
        if len(known) > KNOWN_WORDS:
            known.clear()
        for w in {*words}.difference(known):
            known[w] = xxhash.xxh64_intdigest(w) >> 1
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words)).view(np.uint64)

    def roll(self, x: np.ndarray, size: int) -> np.ndarray:
        """The hash of the ``size`` words from each place on."""
        n = max(0, len(x) - size + 1)
        h = np.zeros(n, dtype=np.uint64)
        for i in range(size):
            h = (h + x[i : i + n]) * MULT
            h ^= h >> np.uint64(29)
        return h * MULT

    def keys(self, h: np.ndarray, beside: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray, moves: int) -> tuple[np.ndarray, np.ndarray]:
        """The keys of the pieces ``h`` at ``at`` with each neighbour, moved by up to ``moves``, and which lie within lo .. hi."""
        if not self.sides:
            return h.view(np.int64)[:, None], np.ones((len(h), 1), dtype=bool)
        cols, valid = [], []
        for k, (side, j) in enumerate(self.sides):
            base = at + self.piece + j * self.beside if side else at - (j + 1) * self.beside
            own = (h ^ np.uint64(k + 1)) * MULT
            for s in range(-moves, moves + 1):
                place = base + s
                ok = (place >= lo) & (place + self.beside <= hi) & ((place >= at + self.piece) if side else (place + self.beside <= at))
                mixed = own + beside[np.where(ok, place, 0)] if len(beside) else own
                cols.append(((mixed ^ (mixed >> np.uint64(31))) * MULT).view(np.int64))
                valid.append(ok)
        return np.stack(cols, axis=1), np.stack(valid, axis=1)

    def cut_items(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The aligned pieces of items, with the words that a passage with the piece can reach."""
        reach, p = self.window - self.piece, self.piece
        for batch in batches:
            rows: list[tuple] = []
            for item, text in zip(batch["item_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                words = words_of(text)
                if len(words) < self.window:
                    continue
                x = self.numbers(words)
                at = np.arange(0, len(words) - p + 1, p)
                h = self.roll(x, p)[at]
                n = np.full(len(at), len(words))
                keys, there = self.keys(h, self.roll(x, self.beside), at, np.maximum(at - reach, 0), np.minimum(at + p + reach, n), 0)
                for a, k, own, ok in zip(at.tolist(), h.view(np.int64).tolist(), keys, there, strict=True):
                    rows.append((k, item, a, " ".join(words[max(0, a - reach) : a]), " ".join(words[a : a + p + reach]), own[ok]))
                if len(rows) > 5_000:
                    yield _batch(rows, PLACES)
                    rows = []
            yield _batch(rows, PLACES)

    def search(self, batches: Iterator[pa.RecordBatch], pieces: tuple[np.ndarray, int], pairs: tuple[np.ndarray, int]) -> Iterator[pa.RecordBatch]:
        """The places of documents that may have a piece with a neighbour, by the maps of both, and the words around them."""
        reach, p = self.window - self.piece + self.budget, self.piece
        for batch in batches:
            words: list[str] = []
            ids, starts = [], [0]
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist(), strict=True):
                own = words_of(text)
                if len(own) >= p:
                    words += own
                    ids.append(doc)
                    starts.append(len(words))
            if not ids:
                continue
            x, start = self.numbers(words), np.array(starts)
            h = self.roll(x, p)
            at = np.flatnonzero(_marked(h, pieces))
            owner = np.searchsorted(start, at, side="right") - 1
            inside = at + p <= start[owner + 1]
            at, owner = at[inside], owner[inside]
            lo, hi = start[owner], start[owner + 1]
            beside = self.roll(x, self.beside)
            for k in range(0, len(at), 20_000):
                a, o = at[k : k + 20_000], owner[k : k + 20_000]
                keys, there = self.keys(h[a], beside, a, np.maximum(lo[k : k + 20_000], a - reach), np.minimum(hi[k : k + 20_000], a + p + reach), self.budget)
                there &= _marked(keys.view(np.uint64), pairs)
                some = np.flatnonzero(there.any(axis=1))
                a, o = a[some], o[some]
                rows = []
                for place, doc, hashed, first, last, own, ok in zip(a.tolist(), o.tolist(), h[a].view(np.int64).tolist(), start[o].tolist(), start[o + 1].tolist(), keys[some].tolist(), there[some].tolist(), strict=True):
                    rows.append((hashed, ids[doc], place - first, " ".join(words[max(first, place - reach) : place]), " ".join(words[place : min(last, place + p + reach)]), list({x for x, y in zip(own, ok, strict=True) if y})))
                if rows:
                    yield _batch(rows, HITS)

    def verify(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each pair of surroundings the passage of the item with the least distance, if that is within the budget.

        item_word and doc_word count from the piece. Words are compared themselves here, not by hash.
        """
        w, e, p = self.window, self.budget, self.piece
        span = w + 2 * e
        for batch in batches:
            for k in range(0, batch.num_rows, PASS_PAIRS // max(1, w - p + 1)):
                part = batch.slice(k, PASS_PAIRS // max(1, w - p + 1))
                number: dict[str, int] = {}
                get = lambda s: [number.setdefault(x, len(number) + 1) for x in s.split(" ")] if s else []  # noqa: B023, E731
                owner, pattern, text, n, first, begin = [], [], [], [], [], []
                for i, (il, ir, dl, dr) in enumerate(zip(*(part[c].to_pylist() for c in ("item_left", "item_right", "doc_left", "doc_right")), strict=True)):
                    a, b = get(il), get(dl)
                    item, doc = a + get(ir), b + get(dr)
                    for s in range(max(0, len(a) + p - w), min(len(a), len(item) - w) + 1):
                        d0 = len(b) - (len(a) - s) - e
                        own = doc[max(0, d0) : d0 + span]
                        owner.append(i)
                        pattern.append(item[s : s + w])
                        text.append(own + [0] * (span - len(own)))
                        n.append(len(own))
                        first.append(s - len(a))
                        begin.append(max(0, d0) - len(b))
                if not owner:
                    continue
                dist, end = self.compare(np.array(pattern, dtype=np.int32), np.array(text, dtype=np.int32), np.array(n))
                own, first = np.array(owner), np.array(first)
                order = np.lexsort((first, dist, own))
                order = order[np.r_[True, own[order][1:] != own[order][:-1]]]
                order = order[dist[order] <= e]
                place = (np.array(begin) + end - w)[order]
                cols = {c: part[c].take(pa.array(own[order])) for c in ("item_left", "item_right", "doc_left", "doc_right")}
                yield pa.RecordBatch.from_pydict(cols | {"distance": pa.array(dist[order].astype(np.int32)), "item_word": pa.array(first[order].astype(np.int32)), "doc_word": pa.array(place.astype(np.int32))})


def _marked(h: np.ndarray, map_: tuple[np.ndarray, int]) -> np.ndarray:
    bits, shift = map_
    slot = (h >> np.uint64(shift)).astype(np.int64)
    return (bits[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64())}
    names = [c.split() for c in ddl.split(", ")]
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(cols, names, strict=True)], names=[n for n, _ in names])


def bit_map(hashes: DataFrame, n: int) -> tuple[np.ndarray, int]:
    """(bytes, shift) of a map with the bit of each hash's first bits set. What reaches the driver are the words of the map, 2^21 at most."""
    power = min(MOST_BITS, max(LEAST_BITS, (16 * n).bit_length()))
    word = F.shiftrightunsigned("h", 64 - power + 6)
    bit = F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(h, {64 - power}) & 63 AS INT))")
    rows = hashes.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(1 << (power - 6), dtype=np.int64)
    out[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return out.view(np.uint8), 64 - power


def leaks(docs: DataFrame, items: DataFrame, *, doc_col: str = "doc_id", doc_text: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = 16, budget: int = 1) -> DataFrame:
    """doc_id, item_id, distance, item_word, doc_word: documents with a passage of ``window`` consecutive words of an item.

    distance is the least number of word edits (insertions, deletions, substitutions), at most ``budget``, between such a
    passage and a stretch of the document; 0: the words stand there verbatim. item_word and doc_word are about where the
    first passage found with that distance begins. Words are runs of letters or digits, in lower case. Null and empty
    texts and items of fewer words match nothing; repeated rows count once; an empty table gives an empty result; other
    columns are ignored. Neither items nor documents nor pairs reach the driver. The result reads tables of
    :func:`tidewell.session.cut`.
    """
    pieces = Pieces(window, budget)
    test = items.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(item_text).alias("text")).filter("item_id IS NOT NULL AND text IS NOT NULL").distinct()
    corpus = docs.select(F.col(doc_col).cast("bigint").alias("doc_id"), F.col(doc_text).alias("text")).filter("doc_id IS NOT NULL AND text != ''")
    places = cut(test.mapInArrow(pieces.cut_items, PLACES))
    n = places.count()
    shared = docs.sparkSession.sparkContext.broadcast((bit_map(places, n), bit_map(places.select(F.explode("keys").alias("h")), n * max(1, len(pieces.sides)))))
    hits = cut(corpus.mapInArrow(lambda it: pieces.search(it, *shared.value), HITS))
    # Surroundings, each once; what follows takes as long as there are different ones.
    side = lambda df, name: df.select("h", F.col("left").alias(f"{name}_left"), F.col("right").alias(f"{name}_right"), "keys").dropDuplicates(["h", f"{name}_left", f"{name}_right"]).select(f"{name}_left", f"{name}_right", F.explode("keys").alias("key"))
    pairs = join_hot(cut(side(hits, "doc")), side(places, "item"), ["key"]).drop("key").distinct()
    good = cut(pairs.mapInArrow(pieces.verify, f"item_left string, item_right string, doc_left string, doc_right string, {FOUND}"))
    of = lambda df, name, own: df.select(own, F.col("at").alias(f"{name}_at"), F.col("left").alias(f"{name}_left"), F.col("right").alias(f"{name}_right"))
    found = join_hot(of(hits, "doc", "doc_id"), good, ["doc_left", "doc_right"])
    found = found.groupBy("doc_id", "item_left", "item_right").agg(F.min(F.struct("distance", "item_word", (F.col("doc_at") + F.col("doc_word")).alias("doc_word"))).alias("b"))
    whole = join_hot(cut(found), of(places, "item", "item_id"), ["item_left", "item_right"])
    best = F.min(F.struct("b.distance", (F.col("item_at") + F.col("b.item_word")).alias("item_word"), F.greatest(F.col("b.doc_word"), F.lit(0)).alias("doc_word"))).alias("b")
    return whole.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.*")
