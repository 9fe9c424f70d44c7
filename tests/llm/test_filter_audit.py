import random
import re
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from custseg.llm import filter_audit
from tests.llm.helpers import CLASHES, documents, sentence

LABELS = "doc_id long, quality int, toxic int"


def brute(rows, labels):
    """Every order applied row by row, for tables with a lang of None, '' or 'en'."""
    smallest = {}
    for i, t, _ in rows:
        if i is not None:
            smallest[t or ""] = min(smallest.get(t or "", i), i)
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, x in labels if x == 1}
    marked = []
    for i, t, part in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search("[#$%&*|]", t)),
                 "E": i is not None and i > smallest[t]}
        marked.append((part or "", {f for f in fails if fails[f]}, i is not None and i in good, i is not None and i in toxic))
    out = set()
    for part in {m[0] for m in marked}:
        own = [m for m in marked if m[0] == part]
        taken = dict.fromkeys("ABCDE", 0)
        steps = []
        for order in permutations("ABCDE"):
            left = own
            for k, f in enumerate(order, 1):
                lost = [m for m in left if f in m[1]]
                left = [m for m in left if f not in m[1]]
                taken[f] += len(lost)
                steps.append(("".join(order), k, len(left), len(lost), sum(f in m[1] for m in own) - len(lost),
                              sum(m[1] == {f} for m in own), sum(m[2] for m in lost), sum(m[3] for m in lost)))
        out |= {(part, *s, taken[s[0][s[1] - 1]]) for s in steps}
    return out


def frame(spark, rows, clash=False):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for k, name in enumerate([*CLASHES, "mask", "part", "good", "toxic", "deal", "words"] if clash else []):
        docs = docs.withColumn(name, F.lit(k))
    return docs


def check(spark, rows, labels, clash=False):
    marked = filter_audit.marked(frame(spark, rows, clash))
    got = filter_audit.audit(filter_audit.cells(marked, spark.createDataFrame(labels, LABELS))).collect()
    assert len(got) == 600 * len({p or "" for _, _, p in rows})
    assert {tuple(r) for r in got} == brute(rows, labels)


def texts(rng, n):
    out = []
    for _ in range(n):
        t = sentence(rng, rng.choice([20, 99, 100, 130, 150]))
        if rng.random() < 0.4:
            t = " ".join(f"{w}{k}" for k, w in enumerate(t.split()))
        if rng.random() < 0.3:
            t = t.upper()
        if rng.random() < 0.3:
            t += rng.choice(["#", " $5", "|", "&"])
        out.append(t)
    return out


def test_all_orders_equal_brute_force(spark):
    rng = random.Random(3)
    pool = texts(rng, 60)
    rows = [(i, rng.choice(pool), rng.choice(["en", "de", "", None])) for i in range(250)]
    rows += [(1_000 + i, pool[0], "en") for i in range(150)]          # one text in a third of the rows
    rows += [(None, pool[0], "en"), (None, None, "en"), (None, "only here", None), (400, None, "en"), (401, "", "de"),
             (402, " \t\n", "en"), (7, rows[7][1], "en"), (7, rows[7][1], "en"), (7, rows[7][1], "de"),
             (403, "Long # " * 40_000, "fr"), (404, " ".join("abc") + " é x", "fr")]
    labels = [(i, rng.randint(0, 1), rng.randint(0, 1)) for i in range(0, 250, 2)]
    labels += [(8, 1, 1), (8, 0, 0), (1_003, 1, None), (None, 1, 1), (5_000, 1, 1)]
    rng.shuffle(rows)
    check(spark, rows, labels, clash=True)


def test_limits_are_exact(spark):
    words = [f"w{k}" for k in range(100)]
    rows = [(1, " ".join(words), "en"), (2, " ".join(words[:99]), "en"), (3, " ".join(words[:80] + ["w0"] * 20), "en"),
            (4, " ".join(words[:79] + ["w0"] * 21), "en"), (5, "A" + "b" * 9, "en"), (6, "AA" + "b" * 9, "en"), (7, "AÉéb", "en")]
    check(spark, rows, [(1, 1, 0), (4, 0, 1)])


def test_walk_equals_every_subset():
    rng = np.random.default_rng(1)
    masks = rng.permutation(32)[:20]
    counts = rng.integers(0, 50, (20, 3))
    alive = filter_audit.survivors(masks, counts)
    for s in range(32):
        assert (alive[s] == counts[(masks & s) == 0].sum(0)).all()


def test_empty_tables(spark):
    empty = spark.createDataFrame([], LABELS)
    marked = filter_audit.marked(documents(spark, []))
    assert filter_audit.audit(filter_audit.cells(marked, empty)).count() == 0
    marked = filter_audit.marked(documents(spark, [(1, "x", "a")]))
    assert filter_audit.audit(filter_audit.cells(marked, empty)).count() == 600
