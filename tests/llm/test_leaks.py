import random

import numpy as np
import pytest
from conftest import rows

import tidewell.llm.leaks as module
from tidewell.llm.leaks import Pieces, leaks, myers, words_of

DOC, ITEM = "doc_id bigint, text string, item_id int, distance int", "item_id bigint, suite string, text string, doc_id int"


def distance(a, b):
    """Least edits of the whole of a against any stretch of b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_myers():
    r = random.Random(1)
    for m in (1, 5, 16, 63):
        a = [[r.randrange(3) + 1 for _ in range(m)] for _ in range(100)]
        b = [[r.randrange(3) + 1 for _ in range(r.randrange(40))] for _ in range(100)]
        dist, end = myers(np.array(a), np.array([x + [0] * (40 - len(x)) for x in b]), np.array([len(x) for x in b]))
        assert dist.tolist() == [distance(x, y) for x, y in zip(a, b, strict=True)]
        assert all(distance(x, y[:e]) == d for x, y, d, e in zip(a, b, dist.tolist(), end.tolist(), strict=True))


def test_words():
    assert words_of("Über-Straße_x2 ½ “A”\n漢字 naïve") == ["über", "straße", "x2", "½", "a", "漢字", "naïve"] and words_of("") == [] and words_of("--") == [""]


def brute(docs, items, w, e):
    out = {}
    for d, t, *_ in set(docs):
        for i, _, x, *_ in set(items):
            if None in (d, t, i, x):
                continue
            a, b = words_of(x), words_of(t)
            best = min((distance(a[s : s + w], b) for s in range(len(a) - w + 1)), default=99)
            if best <= e:
                out[d, i] = min(out.get((d, i), 99), best)
    return sorted((d, i, n) for (d, i), n in out.items())


@pytest.mark.parametrize(("w", "e"), [(16, 1), (16, 0), (8, 1), (12, 2), (3, 2), (1, 0)])
def test_as_brute_force(spark, w, e):
    r = random.Random(w + e)
    word = lambda: f"w{r.randrange(60)}"
    items = [(i, "s", " ".join(word() for _ in range(r.randrange(w - 2, 3 * w))), 0) for i in range(25)]
    docs = []
    for d in range(120):
        body = [word() for _ in range(r.randrange(40))]
        if r.random() < 0.7:
            src = words_of(r.choice(items)[2])
            s = r.randrange(max(1, len(src) - w + 1))
            cut = src[s : s + w + r.randrange(-2, 4)]
            for _ in range(r.randrange(3)):
                if not cut:
                    break
                k = r.randrange(len(cut))
                cut = r.choice([cut[:k] + cut[k + 1 :], [*cut[:k], "new", *cut[k:]], [*cut[:k], word(), *cut[k + 1 :]]])
            at = r.randrange(len(body) + 1)
            body = body[:at] + cut + body[at:]
        docs.append((d, r.choice([" ", ", ", "--"]).join(body).upper(), 0, 0))
    docs += [(500, None, 0, 0), (501, "", 0, 0), (None, docs[0][1], 0, 0), *docs[:5]]
    items += [(90, "s", None, 0), (91, "s", "", 0), (92, "s", "short", 0), (None, "s", items[0][2], 0), items[0]]
    got = leaks(spark.createDataFrame(docs, DOC).repartition(3), spark.createDataFrame(items, ITEM), window=w, budget=e)
    assert sorted(rows(got, "doc_id", "item_id", "distance")) == brute(docs, items, w, e)


def test_long_repetitive_and_empty(spark):
    items = [(1, "s", "a b " * 20, 0)]
    docs = [(1, "a b " * 20_000, 0, 0), (2, "a " * 5_000, 0, 0)]
    got = leaks(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM))
    assert rows(got, "doc_id", "item_id", "distance") == [(1, 1, 0)]
    assert leaks(spark.createDataFrame([], DOC), spark.createDataFrame(items, ITEM)).count() == 0
    assert leaks(spark.createDataFrame(docs, DOC), spark.createDataFrame([], ITEM)).count() == 0
    with pytest.raises(ValueError):
        Pieces(3, 5)


def test_every_row_is_verified(spark, monkeypatch):
    """Without the edit distance nothing comes out, not even what stands verbatim."""
    text = " ".join(f"w{k}" for k in range(40))
    docs, items = spark.createDataFrame([(1, text, 0, 0)], DOC), spark.createDataFrame([(1, "s", text, 0)], ITEM)
    assert rows(leaks(docs, items), "doc_id", "item_id", "distance", "item_word", "doc_word") == [(1, 1, 0, 0, 0)]
    monkeypatch.setattr(module, "myers", lambda p, t, n: (np.full(len(p), 99), np.zeros(len(p), np.int64)))
    assert leaks(docs, items).count() == 0


def test_common_phrases_stay_linear(spark, monkeypatch):
    """A phrase that all items and documents have makes no pairs of items and documents that go on differently."""
    phrase = "choose the best answer below"
    text = lambda k: " ".join([*(f"a{k}x{i}" for i in range(8)), phrase, *(f"b{k}x{i}" for i in range(12))])
    docs = [(k, text(k + 990), 0, 0) for k in range(2000)]  # 10 of them have an item
    items = [(k, "s", text(k), 0) for k in range(1000)]
    pairs = []
    real = module.join_hot
    monkeypatch.setattr(module, "join_hot", lambda a, b, on, **k: pairs.append((on, real(a, b, on, **k))) or pairs[-1][1])
    got = leaks(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM))
    assert rows(got, "doc_id", "item_id", "distance") == [(k, k + 990, 0) for k in range(10)]
    assert next(df for on, df in pairs if on == ["key"]).drop("key").distinct().count() < 2000


def test_one_passage_in_most_documents(spark, monkeypatch):
    """Copies count as one until the end, also where their keys are joined apart."""
    import tidewell.operators.skewed as skewed

    monkeypatch.setattr(skewed, "HOT_LEAST", 10)
    text = " ".join(f"w{k}" for k in range(30))
    docs = [(k, f"d{k} {text} e{k}", 0, 0) for k in range(300)]
    items = [(k, "s", f"{text} i{k}", 0) for k in range(5)]
    assert leaks(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM)).filter("distance = 0").count() == 1500
