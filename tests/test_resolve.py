"""Fuzzy self-join equals brute force; grouping equals union-find."""

import random

import pytest

from custseg.functions.similarity import indel_ratio, lcs_length
from custseg.operators import resolve, segments


def _lcs_dp(a, b):
    prev = [0] * (len(b) + 1)
    for ca in a:
        cur = [0]
        for j, cb in enumerate(b):
            cur.append(prev[j] + 1 if ca == cb else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


def test_bit_parallel_lcs_equals_dp():
    rnd = random.Random(3)
    for _ in range(2000):
        a = "".join(rnd.choice("abcä ") for _ in range(rnd.randint(0, 30)))
        b = "".join(rnd.choice("abcä ") for _ in range(rnd.randint(0, 30)))
        assert lcs_length(a, b) == _lcs_dp(a, b)
    assert indel_ratio("max mustermann", "max mustermnn") > 96
    assert indel_ratio("", "") == 100.0


def _keys(seed, n=400):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcde") for _ in range(rnd.randint(2, 26))) for _ in range(n // 3)]
    keys = list(base)
    for s in base:                      # near copies: one or two edits
        t = list(s)
        for _ in range(rnd.randint(1, 2)):
            op = rnd.random()
            pos = rnd.randrange(len(t) + 1)
            if op < 0.4 and t:
                del t[min(pos, len(t) - 1)]
            elif op < 0.8:
                t.insert(pos, rnd.choice("abcde"))
            elif t:
                t[min(pos, len(t) - 1)] = rnd.choice("abcde")
        keys.append("".join(t))
    keys += base[:20]                   # exact duplicates
    return keys


def _brute(keys, cutoff=90):
    ks = sorted(set(keys))
    out = set()
    for i, a in enumerate(ks):
        for b in ks[i + 1:]:
            if 200 * lcs_length(a, b) >= cutoff * (len(a) + len(b)):
                out.add((a, b))
    return out


def test_fuzzy_pairs_equal_brute_force(spark):
    keys = _keys(7)
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    got = {(r.key_a, r.key_b) for r in resolve.similar_key_pairs(df, "key").collect()}
    assert got == _brute(keys)


def test_components_equal_union_find(spark):
    keys = _keys(11, 300)
    pairs = _brute(keys)
    parent = {k: k for k in set(keys)}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in pairs:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    rows = [(i, k) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "id long, key string")
    out = {r.id: r.group_key for r in resolve.resolve_components(df, "id", "key", "id").collect()}
    first_of_root = {}
    for i, k in rows:
        first_of_root.setdefault(find(k), k)
    for i, k in rows:
        assert out[i] == first_of_root[find(k)]


def _walk_labels(keys, matches):
    """Behaviour of the source's grouping, simulated directly: links i<j in row-major order,
    each group absorbs the not-yet-absorbed groups it reaches while its member list grows,
    then groups stamp their members in key order (later groups overwrite)."""
    n = len(keys)
    links = [(i, j) for i in range(n) for j in range(i + 1, n)
             if keys[i] == keys[j] or (min(keys[i], keys[j]), max(keys[i], keys[j])) in matches]
    groups = {}
    for i, j in links:
        groups.setdefault(i, []).append(j)
    for g in list(groups):
        if g not in groups:
            continue
        members = groups[g]
        pos = 0
        while pos < len(members):
            v = members[pos]
            if v in groups and v != g:
                members.extend(groups.pop(v))
            pos += 1
    label = list(range(n))
    for g, members in groups.items():
        for v in [g] + members:
            label[v] = g
    return label


def test_ordered_mode_equals_walk(spark):
    rnd = random.Random(21)
    for trial in range(3):
        pool = _keys(30 + trial, 60)
        keys = [rnd.choice(pool) for _ in range(90)]        # many duplicates, interleaved
        matches = _brute(keys)
        expect = _walk_labels(keys, matches)
        df = spark.createDataFrame([(i, k, i * 3 + 1) for i, k in enumerate(keys)],
                                   "id long, key string, ord long")
        out = resolve.resolve_ordered(df, "id", "key", "ord", bucket=4)
        got = {r.id: r.group_key for r in out.collect()}
        assert all(got[i] == keys[expect[i]] for i in range(len(keys))), trial


def test_ordered_fork():
    # 0-2 and 1-2 linked, 0 and 1 not: {0}, {1, 2}
    assert _walk_labels(["aaaaaaaaaa", "bbbbbbbbbb", "x"], set()) == [0, 1, 2]


@pytest.mark.parametrize("cutoff", [85, 95])
def test_fuzzy_pairs_other_cutoffs(spark, cutoff):
    keys = _keys(17, 240)
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    got = {(r.key_a, r.key_b) for r in resolve.similar_key_pairs(df, "key", cutoff=cutoff).collect()}
    assert got == _brute(keys, cutoff)


@pytest.mark.parametrize("cutoff", [60, 70, 83])
def test_fuzzy_pairs_low_cutoffs(spark, cutoff):
    keys = _keys(23, 150) + ["a", "b", "ab", "ba", "ä", ""]
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    got = {(r.key_a, r.key_b) for r in resolve.similar_key_pairs(df, "key", cutoff=cutoff).collect()}
    assert got == _brute([k for k in keys if k], cutoff)


@pytest.mark.parametrize("method,cutoff,hot", [("prefix", 90, 1), ("segments", 90, 0), ("segments", 90, 3), ("segments", 86, 8),
                                               ("segments", 97, 2)])
def test_both_candidate_methods_equal_brute_force(spark, monkeypatch, method, cutoff, hot):
    """Keys of all lengths, under and over the longest cut one, some with a common beginning."""
    monkeypatch.setattr(segments.segment_candidates, "__defaults__", (hot,))
    rnd = random.Random(cutoff + hot)
    keys = _keys(29, 150)
    for n in (40, 60, 64, 66, 78, 90):
        base = "http://www." * (n % 4) + "".join(rnd.choice("abcdefgh") for _ in range(n))
        for _ in range(8):
            t = list(base)
            for _ in range(rnd.randint(1, 9)):
                t[rnd.randrange(len(t))] = rnd.choice(["", "x", "ab"])
            keys.append("".join(t))
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    got = {(r.key_a, r.key_b) for r in resolve.similar_key_pairs(df, "key", cutoff=cutoff, method=method).collect()}
    assert got == _brute(keys, cutoff)


def test_segments_fit_into_every_length():
    for cutoff in range(segments.LEAST_CUTOFF, 101):
        for m in range(1, segments.LONGEST + 1):
            sizes = [size for _, size in segments.cuts(m, cutoff)]
            assert not sizes or (min(sizes) >= 1 and sum(sizes) == m)
            assert len(sizes) == (segments.edits(m, m * (200 - cutoff) // cutoff, cutoff) + segments.LEVELS if sizes else 0)


def test_candidates_grow_slower_than_the_keys(spark):
    """Random names with common endings: ten times the keys, far fewer than ten times the candidates a key."""
    def per_key(n):
        rnd = random.Random(n)
        word = lambda: "".join(rnd.choice("abcdefghijklmnoprstuvwz") for _ in range(rnd.randint(4, 9)))
        words = [word() for _ in range(n // 2)]
        rows = [(f"{rnd.choice(words)} {rnd.choice(words)} {rnd.choice(['gmbh', 'kg', 'ag', 'ohg', 'e.k.'])}",) for _ in range(n)]
        keys = resolve.distinct_keys(spark.createDataFrame(rows, "key string"), "key")
        return segments.segment_candidates(keys, 90).count() / n
    few, many = per_key(300), per_key(3_000)
    assert many < 6 * few


def test_odd_cutoffs_rejected(spark):
    df = spark.createDataFrame([("ab",)], "key string")
    with pytest.raises(ValueError):
        resolve.similar_key_pairs(df, "key", cutoff=0)


def test_a_long_shuffled_chain_is_one_component(spark):
    order = list(range(300))
    random.Random(3).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:])), "src long, dst long")
    got = resolve.connected_components(edges).collect()
    assert len(got) == 300 and {r.component for r in got} == {0}


@pytest.mark.parametrize("method,cutoff,words", [("prefix", 90, 1), ("segments", 90, 1), ("prefix", 75, 1), ("prefix", 90, 2)])
def test_crowded_keys_meet_in_blocks_not_by_signatures(spark, monkeypatch, method, cutoff, words):
    """URLs of one grammar share their signatures: no candidate of theirs is joined, and nothing is lost between
    them, keys that share little, and keys above 64 characters."""
    joined = []
    real = resolve.candidate_pairs
    monkeypatch.setattr(resolve, "candidate_pairs", lambda keys, *args, **kw: joined.append(keys.count()) or real(keys, *args, **kw))
    rnd = random.Random(cutoff + words)
    word = "".join(rnd.choice("qjxkvzw") for _ in range(60 * (words - 1)))
    urls = [f"https://{rnd.choice(['www.', 'm.', ''])}th{word}er.example.net/{rnd.choice(['en', 'de'])}/{rnd.randrange(9000)}" for _ in range(150)]
    keys = urls + _keys(43, 30) + ["", "ä😀", "ä😀b", "https://"]
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    found = resolve.similar_key_pairs(df, "key", cutoff=cutoff, method=method).collect()
    assert len(found) == len({(r.key_a, r.key_b) for r in found})
    assert {(r.key_a, r.key_b, r.lcs) for r in found} == {(a, b, lcs_length(a, b)) for a, b in _brute([k for k in keys if k], cutoff)}
    assert joined and max(joined) < 60


def test_block_matches_equal_brute_force():
    from custseg.operators.block_join import block_matches
    rnd = random.Random(8)
    for most, cutoff in ((20, 60), (150, 55), (300, 70)):
        base = ["".join(rnd.choice("abä😀") for _ in range(rnd.randint(0, most))) for _ in range(40)]
        near = ["".join(c for c in k if rnd.random() < 0.9) for k in base]
        for a, b, same in ((sorted(base), near, False), (sorted(base + near), sorted(base + near), True)):
            got = {(i, int(j), int(n)) for i, js, found in block_matches(a, b, cutoff, same) for j, n in zip(js, found)}
            want = {(i, j, lcs_length(x, y)) for i, x in enumerate(a) for j, y in enumerate(b) if (j > i or not same)
                    and lcs_length(x, y) and 200 * lcs_length(x, y) >= cutoff * (len(x) + len(y))}
            assert got == want and len(want) > 30


def test_links_between_crowded_keys_are_few(spark):
    """300 keys that all match: their 44,850 pairs are never listed to group them."""
    keys = [f"https://www.example.net/en/{n}/index.html" for n in range(1000, 1300)]
    df = spark.createDataFrame(list(enumerate(keys)), "id long, key string")
    seen = []
    real = resolve.connected_components
    resolve.connected_components = lambda edges, *cols: seen.append(edges.count()) or real(edges, *cols)
    try:
        out = resolve.resolve_components(df, "id", "key", "id").collect()
    finally:
        resolve.connected_components = real
    assert {r.group_key for r in out} == {keys[0]} and len(out) == 300
    assert seen[0] < 300 * 10


@pytest.mark.parametrize("several", [False, True])
def test_ordered_mode_of_crowded_keys_equals_walk(spark, monkeypatch, several):
    """URLs in a shuffled order: their links are not listed, apart from those of keys with several entries."""
    rnd = random.Random(77)
    urls = sorted({f"http://{rnd.choice(['www.', 'm.', ''])}ther.example.net/{rnd.randrange(900)}" for _ in range(150)})
    rnd.shuffle(urls)
    keys = urls + _keys(3, 24)[:20]
    keys = keys + [rnd.choice(keys) for _ in range(20)] if several else list(dict.fromkeys(keys))
    listed = []
    real = resolve._min_ancestor
    monkeypatch.setattr(resolve, "_min_ancestor", lambda nodes, edges, *more: listed.append(edges.count()) or real(nodes, edges, *more))
    matches = _brute(keys)
    expect = _walk_labels(keys, matches)
    df = spark.createDataFrame(list(enumerate(keys)), "id long, key string")
    got = {r.id: r.group_key for r in resolve.resolve_ordered(df, "id", "key", "id", bucket=8).collect()}
    assert all(got[i] == keys[expect[i]] for i in range(len(keys)))
    assert len(got) == len(keys) and len(matches) > 1000
    assert several or listed[0] < 100


def test_estimated_sizes_stay_small_over_the_rounds_of_owners(spark):
    """A chain of 200 nodes takes several rounds; none of them squares the size that Spark estimates for the next one."""
    edges = spark.createDataFrame([(n, n + 1) for n in range(199)], "src long, dst long")
    owners = resolve._min_ancestor(spark.range(200).toDF("r"), edges)
    assert {(r.node, r.o) for r in owners.collect()} == {(n, 0) for n in range(200)}
    assert owners._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 2 ** 63


def test_matches_of_crowded_keys_leave_python_in_batches(spark, monkeypatch):
    """300 keys that all match: their 44,850 pairs become rows beside the texts of their blocks, with the score that
    Spark's round gives them."""
    from pyspark.sql import functions as F
    sent = []
    frame = type(spark.range(0))
    real = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda self, *args: sent.append(real(self, *args)) or sent[-1])
    keys = [f"https://www.example.net/ä/{n}/index.html" for n in range(1000, 1299)] + ["ä😀" * 3_000]
    df = spark.createDataFrame([(k,) for k in [*keys, "ä😀" * 2_999]], "key string")
    found = resolve.similar_key_pairs(df, "key", cutoff=75)
    assert found.count() == 299 * 298 // 2 + 1
    assert sent[-1].count() < 299 * 298 // 2 / 100
    score = F.round(200.0 * F.col("lcs") / (F.length("key_a") + F.length("key_b")), 6)
    assert found.where(F.col("score") != score).isEmpty()


def test_scores_are_rounded_half_up_like_round(spark):
    """Totals up to 1,200 characters, and one at which the seventh digit is a lone five."""
    from pyspark.sql import functions as F
    totals = spark.range(2, 1201).selectExpr("cast(id as int) as total", "cast(id div 2 as int) as most") \
        .unionByName(spark.createDataFrame([(16384, 8192)], "total int, most int"))
    found = totals.select("total", F.explode(F.sequence(F.lit(1), F.col("most"))).alias("lcs"))
    assert found.count() > 300_000
    assert found.where(resolve.score("lcs", "total") != F.round(200.0 * F.col("lcs") / F.col("total"), 6)).isEmpty()
