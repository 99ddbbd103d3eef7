import random

import numpy as np
import pytest

from corvane.llm import near_dedup as N
from corvane.llm.common import WordHash
from corvane.llm.graph import components, joined


def shingles(text, k):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k=3, pct=85):
    sets = [(d, shingles(t, k)) for d, t in rows if d is not None]
    least = {d: d for d, _ in sets}  # rows of a doc_id are one node, whatever their texts

    def root(x):
        while least[x] != x:
            x = least[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            both = len(s & t)
            if both and 100 * both >= pct * len(s | t):
                x, y = sorted((root(a), root(b)))
                least[y] = x
    return sorted(((d, len(shingles(t, k)), None if d is None else root(d), True if d is None else root(d) == d) for d, t in rows), key=str)


def corpus(seed, groups=12, largest=40, edits=4):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 5)))
    texts = []
    for _ in range(groups):
        base = [word() for _ in range(r.randint(20, 150))]
        for _ in range(r.randint(1, largest)):
            t = list(base)
            for _ in range(r.randint(0, edits)):
                t[r.randrange(len(t))] = word()
            texts.append(r.choice([" ", "\n", " \t"]).join(t).title() if r.random() < 0.3 else " ".join(t))
    r.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed,params,k,pct", [(1, N.Params(), 3, 85), (2, N.Params(small=3, block=8), 3, 85), (3, N.Params(shingle=5, pct=80), 5, 80)])
def test_components_equal_brute_force(spark, seed, params, k, pct):
    rows = corpus(seed)
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), params)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, k, pct)


def test_chain_of_edits_in_large_buckets_is_one_component(spark):
    """Neighbours in the chain are linked, its ends share little: links that the least member of a bucket can't show."""
    r = random.Random(5)
    t = [f"w{i}" for i in range(100)]
    rows = []
    for d in range(60):
        rows.append((d * 7 % 60, " ".join(t)))
        t[r.randrange(100)] = f"x{d}"
        t[r.randrange(100)] = f"y{d}"
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), N.Params(small=2, block=4))
    assert sorted((tuple(x) for x in got.collect()), key=str) == brute(rows)


def test_nulls_ties_empties_and_clashing_columns(spark):
    a = "one two three four five six seven eight nine ten"
    rows = [(3, a), (3, a), (1, a.upper()), (5, None), (6, ""), (7, " \n"), (8, "x"), (9, "X"), (None, a), (None, None), (2, "x y"), (4, "ſ x"), (10, "s x")]
    df = spark.createDataFrame([(d, t, "z", 1) for d, t in rows], "doc_id long, text string, node string, key int")
    got = N.near_duplicates(df)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)
    left = N.representatives(df)
    assert left.columns == df.columns
    assert sorted((r.doc_id for r in left.collect()), key=str) == sorted([1, 2, 4, 5, 6, 7, 8, 10, None, None], key=str)
    assert N.near_duplicates(df.limit(0)).count() == 0


def test_sketches_merge_and_estimate():
    p, h = N.Params(registers=512), WordHash()
    a = N.factors(512)
    x = N.shingle_set(" ".join(f"w{i}" for i in range(1000)).encode(), h, p)
    y = N.shingle_set(" ".join(f"w{i}" for i in range(300, 1300)).encode(), h, p)
    kx, ky = N.sketch(x, a, p.base), N.sketch(y, a, p.base)
    assert (N.merged(kx, ky) == N.sketch(np.union1d(x, y), a, p.base)).all()
    true = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    more, less = np.array([(kx > ky).sum()]), np.array([(kx < ky).sum()])
    got = N.likeliest(more, less, 512 - more - less, np.array([float(len(x))]), np.array([float(len(y))]), p.base)[0]
    assert abs(got - true) < 0.08


def test_components_of_random_graphs(spark):
    r = random.Random(2)
    edges = [(r.randrange(120), r.randrange(120)) for _ in range(70)] + [(i, i + 1) for i in range(200, 260)] + [(5, 5), (7, 8), (8, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    some = spark.createDataFrame(edges[:90], "a long, b long")
    both = joined(components(some), spark.createDataFrame(edges[90:], "a long, b long"))
    assert sorted((x.node, x.component) for x in both.collect()) == sorted((x, find(x)) for x in root if any(x in e and e[0] != e[1] for e in edges))


def test_rows_of_a_doc_id_with_different_texts_are_one_node(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    for rows in ([(3, a), (9, a), (9, b), (12, b), (7, c)], [(12, b), (9, b), (9, a), (3, a), (9, c), (2, c + " d")], [(5, a), (5, b), (5, c)]):
        got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
        assert sorted((tuple(x) for x in got.collect()), key=str) == brute(rows)


def edited(seed, members, words, edits):
    """Members with as many own words each: no two are alike, and none is nearer to the middle than the others."""
    r = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    out = []
    for d in range(members):
        t = list(base)
        for i in r.sample(range(words), edits):
            t[i] = f"x{d}.{i}"
        out.append((d, " ".join(t)))
    return out


@pytest.mark.parametrize("words,edits,block", [(200, 3, 4096), (200, 3, 64), (300, 4, 64)])
def test_members_just_under_the_threshold_give_no_pairs(spark, monkeypatch, words, edits, block):
    """Similarities of 0.73 to 0.79 under a threshold of 0.80: all look plausible to the sketches, none is linked. What the steps make must
    grow with the members."""
    made = {}
    p = N.Params(shingle=5, pct=80, block=block)
    for name in ("_blocks", "_few", "_estimated"):
        f = getattr(N, name)
        monkeypatch.setattr(N, name, lambda *a, f=f, name=name: made.__setitem__(name, (df := N.cut(f(*a))).count()) or df)
    for members in (100, 300):
        rows = edited(1, members, words, edits)
        sims = [(len(x & y), len(x | y)) for x, y in zip([shingles(t, 5) for _, t in rows], [shingles(t, 5) for _, t in rows[1:]])]
        assert max(a / b for a, b in sims) < 0.85 and sum(a / b for a, b in sims) / len(sims) > 0.7
        made.clear()
        got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), p)
        assert sorted((tuple(x) for x in got.collect()), key=str) == brute(rows, 5, 80)
        assert made["_blocks"] < p.bands * members and made["_few"] + made["_estimated"] < p.bands * members


def test_joining_counts_whole_sets():
    r = random.Random(4)
    sets = [N.np.unique(N.np.array(r.sample(range(60), r.randint(1, 40)), N.np.uint64)) for _ in range(80)]
    comp = N.np.array([r.randrange(30) for _ in sets])
    for mine in (N.np.zeros(80, int), N.np.array([i % 2 for i in range(80)])):
        one = bool((mine == 0).all())
        want, got = {}, {}
        links = [(i, j) for i in range(80) for j in range(i) if (one or mine[i] != mine[j]) and 2 * len(set(sets[i]) & set(sets[j])) >= len(set(sets[i]) | set(sets[j]))]
        for root, pairs in ((want, links), (got, list(zip(*N.joining(N.np.arange(80), comp, mine, sets, 50))))):
            find = lambda x: x if root.setdefault(x, x) == x else find(root[x])  # noqa: B023, E731
            for i, j in pairs:
                x, y = sorted((find(int(comp[i])), find(int(comp[j]))))
                root[y] = x
        top = lambda root, x: x if root.get(x, x) == x else top(root, root[x])
        assert {c: top(want, c) for c in comp.tolist()} == {c: top(got, c) for c in comp.tolist()}


def test_rows_shipped_grow_with_members_and_blocks_of_others(spark):
    """One component of all but a few members: each of it is sent once, however many blocks there are; the few to all blocks."""
    p = N.Params(block=50)
    for members, few in ((1000, 10), (4000, 10)):
        rows = [(1, i, 100, 0 if i >= few else i + 1) for i in range(members)]
        met = N._dealt(spark.createDataFrame(rows, "key long, node long, n long, component long"), p)
        blocks = -(-(members - few) // 50)
        assert met.count() == members - few + few * (blocks + 1)
        # every two of different components meet once, but for two of the largest component
        if members == 1000:
            groups: dict = {}
            for r in met.collect():
                groups.setdefault((r.lo, r.hi), []).append((r.node, r.mine))
            seen = {}
            for (lo, hi), g in groups.items():
                for x, mx in g:
                    for y, my in g:
                        if x < y and x < few and (lo == hi or mx != my):
                            seen[x, y] = seen.get((x, y), 0) + 1
            assert set(seen.values()) == {1} and len(seen) == few * (members - few) + few * (few - 1) // 2
    rows = [(1, i, 1 << 20, i) for i in range(30)]  # no component at all, and large sets
    met = N._dealt(spark.createDataFrame(rows, "key long, node long, n long, component long"), N.Params()).collect()
    assert {(r.node, s.node) for r in met for s in met if (r.lo, r.hi) == (s.lo, s.hi) and r.node < s.node and (r.lo == r.hi or r.mine != s.mine)} == {(i, j) for i in range(30) for j in range(i + 1, 30)}
