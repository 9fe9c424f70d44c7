import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from custseg.llm import suffix
from tests.llm.helpers import documents, sentence


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 6), st.lists(st.integers(0, 2), min_size=1, max_size=60))
def test_suffix_array_and_common_prefixes(width, symbols):
    rows = np.array((symbols * width)[:len(symbols) // width * width or width], np.int64).reshape(-1, width)
    sa = suffix.suffix_array(rows)
    text = {i: tuple(rows.ravel()[i:i // width * width + width]) for i in range(rows.size)}
    assert list(sa) == sorted(text, key=lambda i: (text[i], i))
    shared = suffix.common_prefixes(rows, sa)
    for a, b in zip(sa[1:], sa):
        x, y = text[a], text[b]
        assert shared[a] == next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="ab\x00", max_size=30).map(str.encode), min_size=1, max_size=12))
def test_aligned_order(parts):
    order, lcp = suffix.aligned_order(parts, 30)
    padded = [p.ljust(32, b"\0") for p in parts]
    assert [padded[i] for i in order] == sorted(padded)
    for k in range(1, len(order)):
        x, y = padded[order[k]], padded[order[k - 1]]
        assert lcp[k] == next((i for i in range(32) if x[i] != y[i]), 32)


def brute(rows):
    data = [(t or "").encode() for _, t, _ in rows]
    count = Counter(d[i:i + 400] for d in data for i in range(len(d) - 399))
    out = []
    for (key, _, _), d in zip(rows, data):
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - 399):
            if count[d[i:i + 400]] > 1:
                gone[i:i + 400] = True
        spans = int(np.diff(np.concatenate([[0], gone.astype(int)])).clip(0).sum())
        kept = bytes(np.frombuffer(d, np.uint8)[~gone]) if d else b""
        out.append((key, len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def rows_of():
    rng = random.Random(6)
    passage = [sentence(rng, 70), sentence(rng, 90)]
    assert all(len(p) >= 350 for p in passage)
    rows = [(i, sentence(rng, rng.choice([3, 60, 200])), "a") for i in range(25)]
    rows += [(100 + i, f"{sentence(rng, 40)} {passage[i % 2]} {sentence(rng, 40)}", "a") for i in range(24)]
    rows += [(200, rows[30][1], "a"), (201, rows[30][1] + "x", "b"), (202, "For " * 700, "a"), (203, "é" * 600, "a"),
             (204, None, "a"), (205, "", "a"), (206, "z" * 399, "a"), (207, "y" * 400, "a"), (208, "y" * 400, None),
             (None, passage[0], "a"), (30, rows[5][1], "a"), (30, rows[5][1], "a"), (209, sentence(rng, 6000), "a")]
    return rows


@pytest.mark.parametrize("group", [suffix.GROUP_SLICES, 2])
def test_all_repeats_and_hot_passages(spark, monkeypatch, group):
    monkeypatch.setattr(suffix, "GROUP_SLICES", group)
    rows = rows_of()
    got = suffix.remove_repeats(documents(spark, rows, clash=True)).collect()
    order = lambda x: tuple((v is None, v) for v in x)
    assert sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got], key=order) == \
        sorted(brute(rows), key=order)


def test_kept_bytes_and_empty_table(spark):
    rows = [(1, "q" * 20 + "ab" * 300, "a"), (2, "w" * 20 + "ab" * 300, "a")]
    got = {r.doc_id: bytes(r.kept) for r in suffix.remove_repeats(documents(spark, rows), keep_text=True).collect()}
    assert got == {1: b"q" * 20, 2: b"w" * 20}
    assert suffix.remove_repeats(documents(spark, [])).count() == 0


def test_tables_that_grow_with_the_input_are_not_broadcast(spark):
    """One plan at every size: the ranges are grouped in one exchange and meet the texts as they lie."""
    rng = random.Random(11)
    shared = sentence(rng, 150)
    docs = documents(spark, [(n, sentence(rng, 100) + shared + sentence(rng, 30), "s") for n in range(40)] + [(None, shared, "s")] * 2)
    got = suffix.remove_repeats(docs)
    assert {r.n_removed >= suffix.LENGTH for r in got.collect()} == {True}
    plan = got._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("Final Plan"):plan.index("Initial Plan")]
    assert "BroadcastHashJoin" not in plan
    # found places, ranges (two sources), grouped ranges, texts
    assert plan.count("Exchange hashpartitioning") <= 4


def test_slices_cross_one_exchange_at_every_size(spark, monkeypatch):
    """What tells the groups that fit a shard is never shuffled with the slices' bytes."""
    rng = random.Random(12)
    shared = sentence(rng, 90)
    rows = [(n, f"{sentence(rng, 60)} {shared} {sentence(rng, 60)}", "a") for n in range(30)]
    plans = []
    settle = suffix._array_repeats

    def seen(work):
        plans.append(work._jdf.queryExecution().executedPlan().toString())
        return settle(work)

    monkeypatch.setattr(suffix, "_array_repeats", seen)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as on a table of any size
    try:
        got = suffix.remove_repeats(documents(spark, rows)).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(brute(rows))
    assert plans and not any("Exchange hashpartitioning" in p for p in plans)
