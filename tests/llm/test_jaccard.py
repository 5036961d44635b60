import random

import numpy as np
import pytest
from helpers import WORDS, jaccard_components, near_copies, shingles

from tapelake.llm import jaccard_join
from tapelake.llm.jaccard_join import divide_skip, keep_one
from tapelake.llm.jaccard_join import jaccard_components as joined

ODD = [None, "", " \t\n", "one", "One", "a b c d", "a  b\tc D", "a b c d e", "é b c d e", "x\u00a0y b c d e f"]


@pytest.mark.parametrize("block", [1_000_000, 300])
def test_against_all_pairs(spark, block):
    texts = near_copies(block, 120) + ODD
    # A long document with a near copy, and a group of near copies that are not all linked with each other.
    draw = random.Random(1)
    long = [draw.choice(WORDS) for _ in range(3000)]
    texts += [" ".join(long), " ".join(long[:2500])]
    base = [draw.choice(WORDS) for _ in range(60)]
    for k in range(30):
        one = list(base)
        one[2 * k] = "changed"
        texts.append(" ".join(one))
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in joined(spark.createDataFrame(rows, "doc_id long, text string"), block=block).collect()}
    assert got == jaccard_components(rows)


def test_repeated_rows_nulls_and_other_columns(spark):
    text = " ".join(WORDS[:40])
    rows = [(3, text, "x"), (3, text, "y"), (1, text + " more", "z"), (None, text, "n"), (9, None, "e"), (9, "", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, class string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in joined(docs).collect()), key=str)
    assert got == sorted([(3, 36, 1), (3, 36, 1), (1, 37, 1), (None, 36, None), (9, 0, 9), (9, 0, 9)], key=str)
    kept = sorted(((r.doc_id, r["class"]) for r in keep_one(docs).collect()), key=str)
    assert kept == sorted([(1, "z"), (None, "n"), (9, "e"), (9, "e")], key=str)
    assert keep_one(docs).columns == docs.columns


@pytest.mark.parametrize("block", [1_000_000, 50])
def test_one_doc_id_on_several_texts(spark, block):
    a, b, c = (" ".join(WORDS[k : k + 60]) for k in (0, 100, 200))
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (1, a + " z"), (4, c), (5, c), (5, "alone " + c[:100]), (6, c + " x"), (7, b), (0, c[:50])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in joined(docs, block=block).collect()}
    want = {
        (1, 56, 1), (2, 57, 1), (3, 57, 1), (1, 57, 1), (7, 56, 1),
        (4, 56, 4), (5, 56, 4), (6, 57, 4), (5, len(shingles("alone " + c[:100])), 5), (0, len(shingles(c[:50])), 0),
    }
    assert got == want
    kept = sorted((r.doc_id, r.text) for r in keep_one(docs, block=block).collect())
    assert len(kept) == 5 and {(4, c), (5, "alone " + c[:100]), (0, c[:50])} < set(kept)
    assert (1, b) in kept and sum(doc == 1 and text in (a, a + " z") for doc, text in kept) == 1
    assert kept == sorted((r.doc_id, r.text) for r in keep_one(docs.repartition(5), block=block).collect())


def test_keep_one_of_repeated_rows(spark):
    docs = spark.createDataFrame([(1, " ".join(WORDS[:9]))] * 3 + [(2, "other")], "doc_id long, tie string")
    docs = docs.withColumnRenamed("tie", "text")
    assert sorted(r.doc_id for r in keep_one(docs).collect()) == [1, 2]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert joined(docs).collect() == [] and keep_one(docs).collect() == []


def test_divide_skip():
    draw = np.random.default_rng(3)
    sets = [np.unique(draw.integers(0, 60, draw.integers(5, 50))) for _ in range(80)]
    sizes = np.array([len(s) for s in sets])
    got = {(q, int(k)) for q, found in divide_skip(sizes, sets, 75) for k in found}
    want = set()
    for a in range(80):
        for b in range(a + 1, 80):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 75 * (sizes[a] + sizes[b] - both):
                want.add((a, b))
    assert got == want
    assert jaccard_join.least_overlap(4, 75) == 3 and jaccard_join.least_overlap(5, 75) == 4
