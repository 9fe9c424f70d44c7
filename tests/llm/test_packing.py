import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from custseg.llm import catalog, packing
from tests.llm.helpers import documents, sentence


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(catalog.tokenizer_path())


@pytest.fixture(scope="module")
def encoder():
    return packing.WordEncoder(catalog.tokenizer_path(), 1)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def split(ids, counts):
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]


ODD = "ab cdéÉßİΣσ'st'LL0 1½<|endoftext|>\x00\x1c\x85   ́中文😀-_!?.\n\t\x0bÀÅŉǅ"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(max_size=30), st.text(alphabet=ODD, max_size=40)), min_size=1, max_size=5))
def test_ids_equal_the_tokenizers(encoder, tokenizer, texts):
    texts = [t if t is None else t.encode("utf-8", "ignore").decode() for t in texts]
    ids, counts = encoder.encode(pa.array(texts, pa.string()))
    assert split(ids, counts) == [ids_of(tokenizer, t) for t in texts]


def test_ids_of_documents(encoder, tokenizer, spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    ids, counts = encoder.encode(pa.array(texts))
    assert split(ids, counts) == [ids_of(tokenizer, t) for t in texts]


def check(spark, tokenizer, rows, clash=False, **options):
    got = packing.pack(documents(spark, rows, clash), catalog.tokenizer_path(), keep_ids=True, **options).collect()
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in got:
        ids = np.frombuffer(r.ids, "<u2")
        assert len(ids) == r.length > 0 and r.ids_crc32 == zlib.crc32(ids.astype("<u4").tobytes())
        pieces[r.doc_id, r.source].append((r.start, ids.tolist(), r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    want = Counter((i, s, tuple(ids_of(tokenizer, t))) for i, t, s in rows)
    if len({(i, s) for i, _, s in rows}) == len(rows):
        for i, t, s in rows:
            whole = []
            for start, ids, n in sorted(pieces[i, s]):
                assert start == len(whole) and n == len(ids_of(tokenizer, t))
                whole += ids
            assert whole == ids_of(tokenizer, t)
    assert sum(r.length for r in got) == sum(len(k[2]) * n for k, n in want.items())
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048 and (at == 2048 or at & (at - 1) == 0)  # no padding at all
    return got


def test_pieces_and_sequences(spark, tokenizer):
    rng = random.Random(2)
    rows = [(i, sentence(rng, rng.choice([1, 30, 400])), rng.choice(["a", "b", None, "hot", "hot"])) for i in range(150)]
    rows += [(1000, None, "a"), (1001, "", None), (1002, sentence(rng, 30_000), "a"), (None, "x y", "b")]
    check(spark, tokenizer, rows, clash=True)
    check(spark, tokenizer, rows, shard_tokens=4_000)


def test_repeated_rows_and_empty_table(spark, tokenizer):
    check(spark, tokenizer, [(1, "same text here", "a")] * 40)
    assert packing.pack(documents(spark, []), catalog.tokenizer_path()).count() == 0


def test_windows_hold_the_target_shares():
    rng = np.random.default_rng(1)
    queues = [[int(x) + 2 for x in rng.lognormal(6, 1.2, n)] for n in (900, 100, 100, 60)]
    tokens = np.array([sum(q) for q in queues])
    share = tokens / tokens.sum()
    pieces = list(packing.lay_out(packing.round_robin(queues, share, np.zeros(4)), int(tokens.sum())))
    windows = defaultdict(lambda: np.zeros(4))
    for s, _, _, n, sequence, _ in pieces:
        windows[sequence][s] += n
    full = [w for w in windows.values() if w.sum() == 2048]
    worst = max(np.abs(w / 2048 - share).max() for w in full[:-3])
    assert len(full) > 100 and worst < 0.05
    # what one window lacks the next ones give: running totals stay within a quantum or so
    run = np.cumsum(full[:-3], axis=0) - np.outer(np.arange(1, len(full) - 2) * 2048, share)
    assert np.abs(run).max() < 2 * packing.QUANTUM + 4


def test_carried_deficits_are_served_first():
    queues = [[500] * 40, [500] * 40]
    first = list(packing.round_robin(queues, np.array([0.5, 0.5]), np.array([0.0, 900.0])))
    got = Counter()
    for s, _, _, n in first:
        got[s] += n
        if sum(got.values()) >= 2048:
            break
    assert got[1] > 1500
