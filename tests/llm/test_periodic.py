import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from custseg.llm import catalog, periodic
from custseg.llm.recompression import Grammar
from tests.conftest import SF001
from tests.llm.helpers import documents, sentence


def brute_runs(w):
    """Every maximal periodic stretch by its definition, period after period."""
    n, out = len(w), {}
    for p in range(1, n // 3 + 1):
        s = 0
        while s + p < n:
            if w[s] != w[s + p]:
                s += 1
                continue
            e = s
            while e + p < n and w[e] == w[e + p]:
                e += 1
            if e + p - s >= max(24, 3 * p):
                out.setdefault((s, e + p - s), p)
            s = e + 1
    return sorted((s, length, p) for (s, length), p in out.items())


def brute(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def digest(docs):
    rows = periodic.digest(periodic.find_runs(periodic.plant_runs(docs))).drop("n_words").collect()
    return [tuple(r) for r in rows]


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def repeating(rng):
    """Words with repeats of several periods, some inside others, some cut off."""
    w = []
    for _ in range(rng.randint(1, 6)):
        unit = [rng.choice("abcdefgh") for _ in range(rng.randint(1, 14))]
        if rng.random() < 0.4:
            unit = unit * rng.randint(2, 4) + [rng.choice("xyz")]
        w += unit * rng.randint(1, 12) + unit[:rng.randint(0, len(unit))]
        w += [rng.choice("abcdefgh") for _ in range(rng.randint(0, 9))]
    return w


def test_extensions_equal_brute_force():
    rng = random.Random(4)
    for _ in range(150):
        w = repeating(rng)[:70]
        s = np.array([900] + [ord(c) for c in w] + [901])
        g = Grammar(s)
        i, j = np.triu_indices(len(s), 1)
        i, j = i[i > 0], j[i > 0]
        for a, b, f, r in zip(i, j, g.extend(i, j), g.extend(i, j, back=True)):
            assert list(s[a:a + f]) == list(s[b:b + f]) and s[a + f] != s[b + f]
            assert list(s[a - r:a]) == list(s[b - r:b]) and s[a - r - 1] != s[b - r - 1]


def test_grammar_shrinks():
    g = Grammar(np.concatenate([[1], np.random.default_rng(0).integers(10, 500, 20_000), [2]]))
    sizes = [len(x.letters) for x in g.levels]
    assert len(sizes) < 100 and sizes[-1] <= 2 and sum(sizes) < 8 * 2 * 20_000
    assert len(Grammar(np.concatenate([[1], np.full(100_000, 7), [2]])).levels) < 20


def test_runs_equal_brute_force():
    rng = random.Random(5)
    texts = [repeating(rng) for _ in range(300)] + [[], ["a"], ["a"] * 23, ["a"] * 24, ["a", "b"] * 200]
    names = {x: k for k, x in enumerate(sorted({x for t in texts for x in t}))}
    flat = np.array([names[x] for t in texts for x in t])
    got = [[] for _ in texts]
    for t, *run in zip(*(c.tolist() for c in periodic.runs_of(flat, np.array([len(t) for t in texts])))):
        got[t].append(tuple(run))
    for t, runs in zip(texts, got):
        assert runs == brute_runs(t)
    assert sum(map(len, got)) > 300


@pytest.mark.parametrize("slice_bytes", [1, 400, 3 << 20])
def test_documents_equal_brute_force(spark, monkeypatch, slice_bytes):
    monkeypatch.setattr(periodic, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(periodic, "GRID_ROWS", 50)
    rng = random.Random(6)
    rows = [(i, " ".join(repeating(rng)), "a") for i in range(60)] + [(100 + i, sentence(rng, 60), "b") for i in range(60)]
    rows += [(900, None, None), (901, "", "x"), (902, " \t ", "x"), (None, "a b " * 30, "x"), (7, rows[7][1], "a"),
             (7, rows[7][1], "a"), (903, "\n a\tb\x0bc \r" * 20, "x"), (904, "é é   " * 30, "x")]
    assert order(digest(documents(spark, rows, clash=True))) == order([brute(i, t) for i, t, _ in rows])


def test_long_text_and_all_equal_words(spark):
    rng = random.Random(8)
    long = [rng.choice("abcdefghij") + str(rng.randrange(300)) for _ in range(30_000)]
    long[5_000:25_000] = (long[5_000:9_000] * 5)
    rows = [(1, " ".join(long), "a"), (2, "same " * 50_000, "a")]
    got = {r.doc_id: r for r in periodic.find_runs(documents(spark, rows)).collect()}
    assert [tuple(r) for r in got[1].runs if r.period == 4_000] == [(5_000, 20_000, 4_000)]
    assert [tuple(r) for r in got[2].runs] == [(0, 50_000, 1)] and got[2].collapsed == "same"


def test_query_on_test_table(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = [tuple(r) for r in catalog.op11_periodic_runs(spark, SF001).drop("n_words").collect()]
    short = [(r.doc_id, r.text) for r in docs.collect() if len((r.text or "").split()) < 1_500]
    want = {i: brute(i, t) for i, t in short}
    assert len(got) == docs.count() and sum(r[1] > 0 for r in got) > 10
    assert all(want[r[0]] == r for r in got if r[0] in want)


def test_empty_table(spark):
    assert digest(documents(spark, [])) == []
