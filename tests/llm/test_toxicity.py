import binascii

import numpy as np
from conftest import TINY

from tapelake.llm import toxicity

SMALL = TINY.replace("0.001", "0.01")


def auc(scores, labels):
    order = np.argsort(np.argsort(scores)) + 1
    good = labels == 1
    return (order[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def scored(spark, documents, labels):
    return {r.doc_id: r for r in toxicity.score(documents, toxicity.learn(documents, labels)).collect()}


def test_held_out_rows(spark):
    documents, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    got = scored(spark, documents, labels)
    marks = {r.doc_id: r.toxic for r in labels.collect()}
    held = [d for d, r in got.items() if r.held_out and d in marks]
    assert all(r.held_out == (binascii.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())
    scores, truth = np.array([got[d].score for d in held]), np.array([marks[d] for d in held])
    assert auc(scores, truth) > 0.9
    assert ((scores >= 0.3) == (truth == 1)).mean() > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    # Labels of held-out rows, and other columns of the documents, change nothing.
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 1 - toxic ELSE toxic END AS toxic")
    again = scored(spark, documents.selectExpr("doc_id", "text", "doc_id AS lang", "'x' AS label", "1 AS fold"), turned)
    assert {d: r.score for d, r in got.items()} == {d: r.score for d, r in again.items()}


def test_odd_rows(spark):
    documents = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "you idiot"), (4, "!! " * 50000), (5, "\x00 ퟿")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 1), (99, 0)], "doc_id long, toxic int")
    for marks in (labels, labels.where("false")):
        rows = toxicity.score(documents, toxicity.learn(documents, marks)).collect()
        assert len(rows) == 6 and all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
    model = toxicity.learn(documents, labels)
    assert toxicity.score(documents.where("false"), model).collect() == []
    assert toxicity.accepted(documents, model, threshold=2.0).count() == 6
    assert toxicity.learn(documents.where("false"), labels).share == 0


def test_features():
    make = toxicity.Featurizer({"idiot": 3.0}, {"vequ": 2.0})
    rows = make.rows([b"You IDIOT! vequable", b"1d10t st!ll sooo", None, b"idiot " + b"a " * 9 + b"you", b"a"])
    assert rows[0][0] == 1 / 3 and rows[0][2] == 1 / 3 and rows[0][6] == 2 / 3 and rows[0][8] == 1 / 3
    assert rows[1][0] == 1 / 3 and rows[1][11] == 2 / 3 and rows[1][12] == 1 / 3
    assert not rows[2].any() and rows[3][6] == 0
    assert (toxicity.Featurizer({}, {}).rows([b"a"])[0][:13] == 0).all()


def test_trees_and_calibration():
    draw = np.random.default_rng(0)
    rows = draw.uniform(size=(2000, 3))
    labels = ((rows[:, 0] > 0.5) ^ (rows[:, 1] > 0.5)).astype(float)
    trees = toxicity.boost(rows[:1500], labels[:1500])
    assert ((toxicity.predict(trees, rows[1500:]) > 0) == (labels[1500:] == 1)).mean() > 0.95
    assert toxicity.predict(toxicity.boost(np.zeros((5, 2)), np.array([0, 0, 1, 0, 0.0])), np.zeros((1, 2))).shape == (1,)
    x, y = toxicity.isotonic(np.array([1, 2, 3, 4, 4.0]), np.array([0, 1, 0, 1, 1.0]))
    assert (np.diff(y) >= 0).all() and np.interp(2.5, x, y) == 0.5 and np.interp(9, x, y) == 1


def test_several_texts_under_one_id(spark):
    """Which of them is learned from doesn't depend on the order of the rows."""
    words = ["idiot", "moron", "tree", "river", "stone", "cloud"]
    rows = [(k % 150, " ".join(words[(k + j) % (2 if k % 3 == 0 else 6)] for j in range(8)) + f" {k}") for k in range(300)]
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(150)], "doc_id long, toxic int")
    scores = []
    for order in (rows, rows[::-1]):
        documents = spark.createDataFrame(order, "doc_id long, text string").repartition(5 if order is rows else 3)
        scores.append(sorted((r.doc_id, r.score) for r in toxicity.score(documents, toxicity.learn(documents, labels)).collect()))
    assert scores[0] == scores[1]
