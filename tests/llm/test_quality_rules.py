import random

import numpy as np
import pytest

from corvane.llm import quality_rules as Q

R = Q.Rules()


def brute(text, r=R):
    words = [w for w in "".join(c if c not in " \t\n\v\f\r" else " " for c in text or "").split(" ") if w]
    n = len(words)

    def cover(k):
        seen = {}
        for i in range(n - k + 1):
            seen.setdefault(tuple(words[i : i + k]), []).append(i)
        return len({i + j for v in seen.values() if len(v) > 1 for i in v for j in range(k)})

    longest = 0
    for i in range(n):
        for j in range(i):
            k = 0
            while i + k < n and words[i + k] == words[j + k]:
                k += 1
            longest = max(longest, k)
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\v\f\r")]
    again, spans = cover(r.window), cover(r.span)
    failed = n < r.min_words or 100 * again > r.repeat_pct * n
    bad = 100 * spans > r.covered_pct * n or (longest > r.longest_words and 100 * longest > r.longest_pct * n)
    return (n, sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), again, failed, not failed and not bad, spans, longest if longest >= min(r.span, r.window) else 0)


def texts(seed):
    r = random.Random(seed)
    out = ["", " \n\t", "one", "a " * 400, "a b " * 300, "x\x85y z é " * 9, "l #1\nl #1\n \n\nl #1"]
    for _ in range(40):
        t = [r.choice("abcdefghijklmnop") * r.randint(1, 3) for _ in range(r.randint(0, 120))]
        if r.random() < 0.5 and t:
            a = r.randrange(len(t))
            t += t[a : a + r.randint(1, 60)]
        out.append("".join(w + r.choice([" ", "\n", " ", "\t"]) for w in t))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(seed):
    for t in texts(seed):
        assert Q.judged(t.encode(), R) == brute(t), t
        tight = Q.Rules(min_words=3, span=2, longest_words=3, covered_pct=20)
        assert Q.judged(t.encode(), tight) == brute(t, tight), t


def test_suffix_array_is_sorted():
    r = random.Random(1)
    for n in (0, 1, 2, 50, 200):
        ids = np.array([r.randint(0, 2) for _ in range(n)], np.int64)
        sa, lcp = Q.suffix_array(ids)
        want = sorted(range(n), key=lambda i: ids[i:].tolist())
        assert sa.tolist() == want
        for i in range(1, n):
            a, b = ids[want[i - 1] :].tolist(), ids[want[i] :].tolist()
            assert lcp[i] == next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))


def test_operator_on_odd_tables(spark):
    rows = [(1, "a b c " * 20, "x"), (1, "a b c " * 20, "x"), (None, " ".join(map(str, range(30))), None), (2, None, "y"), (3, "long " + " ".join(f"w{i}" for i in range(60_000)), "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    got = sorted((tuple(r) for r in Q.quality_rules(df).collect()), key=str)
    assert got == sorted([(d, *(brute(t) if len(t or "") < 9999 else (60001, *Q.judged(t.encode(), R)[1:]))) for d, t, _ in rows], key=str)
    assert Q.quality_rules(df.limit(0)).count() == 0
    left = Q.passing(df)
    assert left.columns == df.columns and {r.doc_id for r in left.collect()} == {None, 3}
