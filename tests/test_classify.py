"""KNN and evaluation tables against numpy brute force."""

import random

import numpy as np

from custseg.operators import classify as CL


def _np_knn(train, test, k):
    preds = {}
    for qid, qx in test:
        d = [(float(np.sqrt(((np.array(qx) - np.array(tx)) ** 2).sum())), tid, lab) for tid, tx, lab in train]
        d.sort(key=lambda t: (t[0], t[1]))
        top = d[:k]
        zero = [t for t in top if t[0] == 0]
        votes = {}
        for dist, _, lab in (zero or top):
            votes[lab] = votes.get(lab, 0) + (1.0 if zero else 1.0 / dist)
        best = max(votes.values())
        preds[qid] = min(c for c, v in votes.items() if v == best)
    return preds


def _data(seed=2, n=200):
    rnd = random.Random(seed)
    return [(i, [round(rnd.random(), 2), round(rnd.random(), 2)], rnd.randint(0, 2)) for i in range(n)]


def test_knn_predict_equals_brute_force(spark):
    data = _data()
    train, test = data[:150], [(i, x) for i, x, _ in data[150:]]
    test.append((999, train[0][1]))                     # exact duplicate: distance 0
    tdf = spark.createDataFrame([(i, x[0], x[1], lab) for i, x, lab in train], "id long, a double, b double, y int")
    qdf = spark.createDataFrame([(i, x[0], x[1]) for i, x in test], "id long, a double, b double")
    got = {r.id: r.prediction for r in
           CL.knn_predict(qdf, tdf, ["a", "b"], 7, "id", "y").collect()}
    assert got == _np_knn(train, test, 7)


def test_knn_cv_equals_brute_force(spark):
    data = _data(3, 160)
    df = spark.createDataFrame([(i, x[0], x[1], lab) for i, x, lab in data], "id long, a double, b double, y int")
    df = CL.hash_split(df, "id")
    pdf = df.toPandas()
    got = {r.k: r.accuracy for r in CL.knn_cv_scores(df, ["a", "b"], "id", "y", ks=[1, 3, 5]).collect()}
    for k in [1, 3, 5]:
        accs = []
        for f in range(4):
            tr = [(r.id, [r.a, r.b], r.y) for r in pdf.itertuples() if r.fold != f]
            te = [(r.id, [r.a, r.b]) for r in pdf.itertuples() if r.fold == f]
            if not te:
                continue
            p = _np_knn(tr, te, k)
            truth = {r.id: r.y for r in pdf.itertuples() if r.fold == f}
            accs.append(np.mean([p[i] == truth[i] for i in truth]))
        assert abs(got[k] - np.mean(accs)) < 1e-12


def test_hash_split_is_deterministic(spark):
    df = spark.range(5000).withColumnRenamed("id", "cid")
    a = CL.hash_split(df, "cid").toPandas()
    b = CL.hash_split(df.repartition(7), "cid").toPandas().set_index("cid").loc[a.cid]
    assert (a.is_test.values == b.is_test.values).all() and (a.fold.values == b.fold.values).all()
    assert 0.27 < a.is_test.mean() < 0.33 and set(a.fold) == {0, 1, 2, 3}


def test_confusion_and_report(spark):
    rows = [(0, 0), (0, 0), (0, 1), (1, 1), (2, 1)]
    df = spark.createDataFrame(rows, "label int, prediction int")
    cm = {(r.label, r.prediction): (r.n, r.rate) for r in CL.confusion_matrix(df).collect()}
    assert cm[(0, 0)] == (2, 2 / 3) and cm[(2, 2)] == (0, 0.0) and len(cm) == 9
    rep = {r["class"]: r for r in CL.classification_report(df).collect()}
    assert rep["1"].precision == 1 / 3 and rep["1"].recall == 1.0 and rep["2"].f1 == 0.0
    assert rep["accuracy"].precision == 3 / 5 and rep["macro avg"].support == 5


def test_repeated_null_ids_and_bounded_points(spark):
    tdf = spark.createDataFrame([(i, float(i), i // 5) for i in range(10)], "id long, x double, y int")
    qdf = spark.createDataFrame([(7, 0.1), (7, 9.1), (None, 9.2), (8, None)], "id long, x double")
    got = [(r.id, r.x, r.prediction) for r in CL.knn_predict(qdf, tdf, ["x"], 3, "id", "y").collect()]
    assert got == [(7, 0.1, 0), (7, 9.1, 1), (None, 9.2, 1), (8, None, None)]
    few = CL.labelled_points(tdf, ["x"], "id", "y", max_points=4)
    again = CL.labelled_points(tdf.repartition(5), ["x"], "id", "y", max_points=4)
    assert len(few.ids) == 4 and few.n_labelled == 10 and list(few.ids) == list(again.ids)
    none = CL.knn_predict(qdf, tdf.limit(0), ["x"], 3, "id", "y")
    assert [r.prediction for r in none.collect()] == [None] * 4
