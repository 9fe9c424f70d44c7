import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from custseg.llm import minhash
from tests.llm.helpers import documents, sentence


def sets(text):
    words = minhash.words_of(text)
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute(rows):
    found = [sets(t) for _, t, _ in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    inverted = defaultdict(list)
    for i, s in enumerate(found):
        shared = Counter(j for g in s for j in inverted[g])
        for g in s:
            inverted[g].append(i)
        for j, both in shared.items():
            if 100 * both >= 75 * (len(s) + len(found[j]) - both):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    low = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            low[root(k)] = min(low.get(root(k), i), i)
    return [(i, len(found[k]), low.get(root(k))) for k, (i, _, _) in enumerate(rows)]


def check(spark, rows, clash=False):
    got = minhash.near_duplicates(documents(spark, rows, clash)).collect()
    order = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=order) == sorted(brute(rows), key=order)
    return got


def changed(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = "edit" + str(rng.randrange(10**6))
    return " ".join(words)


def test_chains_copies_and_odd_rows(spark):
    rng = random.Random(4)
    rows = [(i, sentence(rng, 80), "a") for i in range(60)]
    for i in range(40):
        rows.append((100 + i, changed(rng, rows[i][1], rng.choice([1, 2, 3, 4])), "a"))
    text = sentence(rng, 120)  # a chain: each like the one before, the ends unlike
    for i in range(12):
        rows.append((300 + i, text, "a"))
        text = changed(rng, text, 3)
    rows += [(400 + i, "one two", "b") for i in range(90)]  # a hot group of copies
    rows += [(600, None, "a"), (601, "", "a"), (602, " \n", None), (603, "ONE two", "a"), (604, "one", "a"),
             (None, rows[0][1], "a"), (605, sentence(rng, 20_000), "a"), (5, rows[5][1], "a")]
    rng.shuffle(rows)
    got = check(spark, rows, clash=True)
    classes = defaultdict(int)
    for r in got:
        if r.n_shingles:
            classes[r.component_id] += r.first
        assert r.kept == (r.doc_id == r.component_id)
        assert r.kept or not r.first
    assert set(classes.values()) == {1}


def test_many_near_copies_that_share_buckets(spark):
    """Pairs around the threshold in one large group: no link between classes may get lost."""
    rng = random.Random(8)
    base = sentence(rng, 60)
    rows = [(i, changed(rng, base, rng.choice([2, 3, 4])), "a") for i in range(150)]
    check(spark, rows)


def test_empty_table(spark):
    assert minhash.near_duplicates(documents(spark, [])).count() == 0


def test_drop_keeps_one_of_each_class(spark):
    rng = random.Random(5)
    a, b = sentence(rng, 60), sentence(rng, 60)
    docs = documents(spark, [(2, a, "x"), (1, changed(rng, a, 1), "x"), (3, b, "x"), (4, None, "x"), (5, "", None)], True)
    out = minhash.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 3, 4, 5]


def test_min_max_estimates_similarity():
    rng = np.random.default_rng(0)
    a, b = minhash.multipliers(400, 1)
    x = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    y = np.concatenate([x[:2500], rng.integers(0, 2**63, 500, dtype=np.uint64)])
    same = (minhash.min_max(x, a, b) == minhash.min_max(y, a, b)).mean()
    assert same == pytest.approx(2500 / 3500, abs=0.06)
