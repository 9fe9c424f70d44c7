import hashlib
import random
import re

from custseg.llm import exact
from tests.llm.helpers import documents, sentence


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, _ in rows]
    groups = {}
    for (i, _, _), t in zip(rows, norm):
        groups.setdefault(t, []).append(i)
    out = []
    for (i, _, _), t in zip(rows, norm):
        known = [x for x in groups[t] if x is not None]
        out.append((i, min(known) if known else None, len(groups[t]), hashlib.sha256(t.encode()).hexdigest()))
    return out


def key(x):
    return tuple((v is None, str(v)) for v in x)


def check(spark, rows, clash=False):
    got = exact.mark_duplicates(documents(spark, rows, clash)).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=key) == \
        sorted(brute(rows), key=key)
    kept = {}
    for r in got:
        kept[r.text_sha256] = kept.get(r.text_sha256, 0) + r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) <= {1}


def test_groups_nulls_spaces_repeats_and_hot_text(spark):
    rng = random.Random(1)
    rows = [(i, sentence(rng), "a") for i in range(120)]
    rows += [(200 + i, rows[i][1].replace(" ", "\t\n "), "b") for i in range(30)]
    rows += [(500 + i, "a licence line", "hot") for i in range(300)]  # a third of all rows
    rows += [(900, None, None), (901, "", "x"), (902, " ", "x"), (903, " ", "x"), (None, "lone", "x"),
             (None, "a licence line", "x"), (7, rows[7][1], "a"), (7, rows[7][1], "a")]
    rows += [(1000, "long " * 60_000, "a"), (1001, "long  " * 60_000, "a")]
    rng.shuffle(rows)
    check(spark, rows, clash=True)


def test_empty_table(spark):
    assert exact.mark_duplicates(documents(spark, [])).count() == 0
    assert exact.drop_duplicates(documents(spark, [])).count() == 0


def test_drop_keeps_all_columns(spark):
    rows = [(3, "x y", "a"), (1, "x  y", "b"), (2, "z", None)]
    docs = documents(spark, rows, clash=True)
    out = exact.drop_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 2]
