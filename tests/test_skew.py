"""A key holding a third of all rows; results independent of the partitioning."""

import random

from custseg.operators import clean, resolve, rfm
from tests.test_resolve import _brute, _walk_labels


def test_hot_key_grouping_both_modes(spark):
    rnd = random.Random(77)
    pool = ["".join(rnd.choice("abcd") for _ in range(rnd.randint(8, 14))) for _ in range(40)]
    hot = pool[0]
    keys = [hot if i % 3 == 0 else rnd.choice(pool) for i in range(240)]     # 1/3 identical
    df = spark.createDataFrame([(i, k, i) for i, k in enumerate(keys)], "id long, key string, ord long")
    matches = _brute(keys)
    walk = _walk_labels(keys, matches)
    got = {r.id: r.group_key for r in resolve.resolve_ordered(df, "id", "key", "ord", bucket=16).collect()}
    assert all(got[i] == keys[walk[i]] for i in range(len(keys)))
    comp = {r.id: r.group_key for r in resolve.resolve_components(df, "id", "key", "ord").collect()}
    assert len({comp[i] for i in range(len(keys)) if keys[i] == hot}) == 1


def test_results_independent_of_partitioning(spark):
    rnd = random.Random(5)
    rows = [(str(i), "c0" if i % 3 == 0 else f"c{rnd.randint(1, 40)}",
             f"2020-01-{rnd.randint(1, 28):02d}", float(rnd.randint(1, 500)), True, None)
            for i in range(3000)]
    base = spark.createDataFrame(rows, "invoice_num string, customer_id string, date string, "
                                       "total double, is_total boolean, item_id string")
    outs = []
    for n in (1, 7, 23):
        df = base.repartition(n)
        r = rfm.rfm_from_invoices(df, "2020-01-01", "2020-01-31")
        f = clean.first_per_key(df.withColumnRenamed("invoice_num", "ord"), "customer_id", "ord", ["total"])
        outs.append((sorted(r.collect()), sorted(f.collect())))
    assert outs[0] == outs[1] == outs[2]
