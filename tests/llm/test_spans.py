import random

import pytest
from conftest import rows

import tidewell.llm.spans as spans
from tidewell.llm.spans import anchors, grow, maximal_repeats, shared_spans

SCHEMA = "doc_id bigint, text string, h int, place int, spans string"


def brute(docs, length):
    where = {}
    for d, t, *_ in docs:
        if d is not None and t is not None:
            for k in range(len(t) - length + 1):
                where.setdefault(t[k : k + length], set()).add(d)
    out = []
    for d, t, *_ in docs:
        if d is None or t is None:
            continue
        got = []
        for k in range(len(t) - length + 1):
            if len(where[t[k : k + length]]) > 1:
                if got and k <= got[-1][1]:
                    got[-1][1] = k + length
                else:
                    got.append([k, k + length])
        if got:
            out.append((d, len(t), sum(b - a for a, b in got), [tuple(x) for x in got]))
    return sorted(out)


def corpus(seed, alphabet, n=70):
    r = random.Random(seed)
    text = lambda k: "".join(r.choice(alphabet) for _ in range(k))
    passages = [text(r.randrange(20, 160)) for _ in range(12)] + [text(9)]
    docs = [(d, "".join(r.choice([text(r.randrange(60)), r.choice(passages), r.choice(passages)[r.randrange(15) :], passages[-1]]) for _ in range(r.randrange(6))), 1, 1, "clash") for d in range(n)]
    docs += [(1000 + k, docs[3][1], 1, 1, "") for k in range(15)] + [(2000, None, 1, 1, ""), (2001, "", 1, 1, ""), (2002, "a" * 300, 1, 1, ""), (2003, "b" + "a" * 90 + "c", 1, 1, ""), (None, docs[0][1], 1, 1, "")]
    own = text(100)
    return [*docs, (3000, own + text(5) + own, 1, 1, "")]


@pytest.mark.parametrize(("alphabet", "length", "gram", "hot"), [("abcdefgh 漢😀", 40, 10, 20_000), ("ab", 30, 8, 20_000), ("abcdefgh", 40, 10, 2), ("ab", 12, 11, 20_000)])
def test_as_brute_force(spark, monkeypatch, alphabet, length, gram, hot):
    monkeypatch.setattr(spans, "BROADCAST_ROWS", 0 if hot == 2 else 500_000)
    docs = corpus(length, alphabet)
    got = shared_spans(spark.createDataFrame(docs, SCHEMA).repartition(3), "doc_id", "text", length=length, gram=gram, task_classes=hot)
    assert sorted((r.doc_id, r.n_chars, r.shared_chars, [tuple(s) for s in r.spans]) for r in got.collect()) == brute(docs, length)


def test_every_stretch_has_an_anchor():
    r = random.Random(4)
    for length, gram in ((40, 10), (20, 19), (50, 1)):
        t = "".join(r.choice("abc") for _ in range(700)) + "z" * 200
        doc, place, *_ = anchors(["x" * (length - 1), t, "", "ab"], length, gram)
        assert set(doc.tolist()) == {1}
        p = place.tolist()
        assert all(any(k <= x <= k + length - gram for x in p) for k in range(len(t) - length + 1))


def test_small_passes_and_empty(spark, monkeypatch):
    monkeypatch.setattr(spans, "PASS_CHARS", 50)
    docs = corpus(9, "abcd", 20)
    got = shared_spans(spark.createDataFrame(docs, SCHEMA), "doc_id", "text", length=30, gram=10)
    assert sorted(rows(got, "doc_id", "shared_chars")) == [(d, s) for d, _, s, _ in brute(docs, 30)]
    assert shared_spans(spark.createDataFrame([], SCHEMA), "doc_id", "text").count() == 0
    with pytest.raises(ValueError):
        shared_spans(spark.createDataFrame([], SCHEMA), "doc_id", "text", length=10, gram=10)


def outermost(docs, length):
    """All stretches of at least ``length`` that stand in another record and lie within no other such stretch."""
    out = set()
    texts = [(d, t) for d, t, *_ in docs if d is not None and t is not None]
    where = {}
    for d, t in texts:
        for k in range(len(t) - length + 1):
            where.setdefault(t[k : k + length], []).append((d, t, k))
    for d, t in texts:
        reached = -1
        for k in range(len(t) - length + 1):
            e = max((k + grow(t, u, k, j) for o, u, j in where[t[k : k + length]] if o != d), default=-1)
            if e > reached:
                out.add((d, k, e))
                reached = e
    return out


def check_repeats(got, docs, length):
    """The spans are all outermost ones; each is verbatim in the other record and can't be extended there."""
    assert {(d, s, e) for d, s, e, *_ in got} == outermost(docs, length)
    text = {d: t for d, t, *_ in docs if d is not None and t is not None}
    by = {}
    for d, s, e, o, p in got:
        a, b = text[d], text[o]
        assert d != o and e - s >= length and a[s:e] == b[p : p + e - s]
        assert s == 0 or p == 0 or a[s - 1] != b[p - 1]
        assert e == len(a) or p + e - s == len(b) or a[e] != b[p + e - s]
        by.setdefault(d, []).append((s, e))
    covered = {}
    for d, spans_ in by.items():
        spans_.sort()
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(spans_, spans_[1:], strict=False))
        covered[d] = len({k for s, e in spans_ for k in range(s, e)})
    assert covered == {d: n for d, _, n, _ in brute(docs, length)}


@pytest.mark.parametrize(("alphabet", "length", "gram", "hot"), [("abcdefgh 漢😀", 40, 10, 20_000), ("ab", 30, 8, 20_000), ("abcdefgh", 40, 10, 2), ("ab", 12, 11, 20_000)])
def test_repeats(spark, monkeypatch, alphabet, length, gram, hot):
    import tidewell.operators.skewed as skewed

    monkeypatch.setattr(skewed, "HOT_LEAST", 10 if hot == 2 else 10**9)
    docs = corpus(length, alphabet)
    got = maximal_repeats(spark.createDataFrame(docs, SCHEMA).repartition(3), "doc_id", "text", length=length, gram=gram, task_classes=hot)
    check_repeats(rows(got, "doc_id", "span_start", "span_end", "other_id", "other_start"), docs, length)


def test_overlapping_repeats_stay_apart(spark):
    """300 characters of record 1 stand in record 2, and 300 others, overlapping the first, in record 3: nowhere all 450."""
    r = random.Random(1)
    text = lambda k: "".join(r.choice("abcdefgh ") for _ in range(k))
    for second in (150, 40):  # overlapping by 150, less than a stretch, and by 260
        a = text(50) + text(300 + second) + text(50)
        docs = [(1, a, 1, 1, ""), (2, text(69) + "<" + a[50:350] + ">" + text(30), 1, 1, ""), (3, text(19) + "<" + a[50 + second : 350 + second] + ">" + text(90), 1, 1, "")]
        got = rows(maximal_repeats(spark.createDataFrame(docs, SCHEMA), "doc_id", "text").filter("doc_id = 1"), "span_start", "span_end", "other_id", "other_start")
        assert sorted(got) == [(50, 350, 2, 70), (50 + second, 350 + second, 3, 20)]
        check_repeats(rows(maximal_repeats(spark.createDataFrame(docs, SCHEMA), "doc_id", "text"), "doc_id", "span_start", "span_end", "other_id", "other_start"), docs, 200)


def test_repeats_behind_others(spark):
    """A repeat all of whose stretches stand in earlier and later records too, none of which has it whole."""
    r = random.Random(2)
    text = lambda k: "".join(r.choice("abcdefgh ") for _ in range(k))
    a = text(900)
    part = lambda s, e: f"{text(20)}<{a[s:e]}>{text(20)}"
    docs = [(50, part(0, 900), 1, 1, ""), (40, part(100, 800), 1, 1, "")]
    docs += [(k, part(s, e), 1, 1, "") for k, (s, e) in enumerate([(0, 300), (90, 420), (210, 560), (350, 700), (500, 900)])]
    docs += [(100 + k, part(s, e), 1, 1, "") for k, (s, e) in enumerate([(0, 310), (80, 430), (200, 570), (340, 710), (490, 900)])]
    check_repeats(rows(maximal_repeats(spark.createDataFrame(docs, SCHEMA), "doc_id", "text"), "doc_id", "span_start", "span_end", "other_id", "other_start"), docs, 200)
    assert maximal_repeats(spark.createDataFrame([], SCHEMA), "doc_id", "text").count() == 0


def test_grow():
    r = random.Random(6)
    for _ in range(300):
        a = "".join(r.choice("ab") for _ in range(r.randrange(400)))
        k = r.randrange(len(a) + 1)
        b = a[:k] + r.choice(["", "c", "cab"]) + a[k + 1 :]
        assert grow(a, b, 0, 0) == next((n for n, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
