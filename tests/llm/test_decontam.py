import hashlib
import random
import re

import pytest

from corvane.llm import decontam as D

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(docs, items, size=13, pct=5):
    words = lambda t: WORD.findall(bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode()))
    wins = []
    for item, t in items:
        w = words(t)
        k = min(size, len(w))
        wins += [(item, tuple(w[i : i + k])) for i in range(len(w) - k + 1) if w]
    out = []
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for item, x in wins:
            for i in range(len(w) - len(x) + 1):
                if tuple(w[i : i + len(x)]) == x:
                    hit |= set(range(i, i + len(x)))
                    found |= {item} - {None}
        sha = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(found), sha, len(hit) > 0 and 100 * len(hit) >= pct * len(w)))
    return sorted(out, key=str)


def tables(seed):
    r = random.Random(seed)
    word = lambda: r.choice(["a", "b", "cc", "dé", "E", "f1", "ggg", "h", "i9", "jk"])
    text = lambda n: "".join(word() + r.choice([" ", ", ", "\n", "-", "  "]) for _ in range(n))
    items = [(i, text(r.choice([1, 2, 4, 6, 12, 13, 14, 30]))) for i in range(25)] + [(3, text(20)), (None, text(15)), (90, None), (91, ""), (92, "!?")]
    docs = []
    for d in range(60):
        t = text(r.randint(0, 60))
        if r.random() < 0.5:
            t += r.choice(items)[1] or ""
            t += text(r.randint(0, 5))
        docs.append((d, t.upper() if r.random() < 0.2 else t))
    return docs + [(5, docs[5][1]), (None, items[3][1]), (77, None), (78, "")], items


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("params", [D.Params(), D.Params(held_words=0), D.Params(shingle=3)])
def test_both_forms_equal_brute_force(spark, seed, params):
    docs, items = tables(seed)
    d = spark.createDataFrame([(a, b, "x", 1) for a, b in docs], "doc_id long, text string, row string, n int")
    i = spark.createDataFrame([(a, b, "x") for a, b in items], "item_id long, text string, doc_id string")
    got = D.decontaminate(d, i, params)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items)
    left = D.clean(d, i, params)
    assert left.columns == d.columns
    flags = [(x, y[-1]) for (x, _), y in zip(sorted(docs, key=lambda z: str((z[0],))), [])] or None
    bad = {r.doc_id for r in got.where("contaminated").collect()}
    assert flags is None and sorted((r.doc_id for r in left.collect()), key=str) == sorted((a for a, _ in docs if a not in bad), key=str)


def test_empty_tables(spark):
    d = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    i = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    for p in (D.Params(), D.Params(held_words=-1)):
        assert D.decontaminate(d.limit(0), i, p).count() == 0
        assert [tuple(r)[1:4] for r in D.decontaminate(d, i.limit(0), p).collect()] == [(2, 0, 0)]


def test_bytes_a_word_are_under_the_stated_bound():
    """What a task holds of a benchmark, after it has come there; and what the driver needs at most."""
    import pickle
    import tracemalloc

    r = random.Random(6)
    for vocabulary, bound in ((10**9, 400), (5000, 200)):
        items = [(i, " ".join(f"word{r.randrange(vocabulary)}" for _ in range(200)).encode()) for i in range(150)]
        tracemalloc.start()
        index = D.Index(items, D.Params())
        index.prefixes(D.np.ones(len(index.tokens), D.np.int64))
        peak = tracemalloc.get_traced_memory()[1]
        sent = pickle.dumps(index)
        del index
        before = tracemalloc.get_traced_memory()[0]
        held = pickle.loads(sent)
        size = tracemalloc.get_traced_memory()[0] - before
        tracemalloc.stop()
        assert size / 30_000 < bound and peak / 30_000 < 3 * bound, (size / 30_000, peak / 30_000)
        assert held.search(*(lambda w: (w, D.WordHash().of(w)))(D.words_of(items[7][1]))) == (200, {7})
