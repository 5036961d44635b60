from helpers import WORDS, near_copies, shingles, words_of

from tapelake.llm.contamination import contained_items, decontaminate


def brute(docs, items):
    out = []
    for doc, text in docs:
        for item, words in items:
            asked, own = shingles(words), shingles(text)
            if 0 < len(words_of(words)) < 5:  # a run of as many words
                n, all_of = len(words_of(words)), words_of(text)
                own = {tuple(all_of[k : k + n]) for k in range(len(all_of) - n + 1)}
            if asked and 100 * len(own & asked) >= 75 * len(asked):
                out.append((doc, item, len(asked), len(own & asked)))
    return sorted(out, key=str)


def test_against_all_pairs(spark):
    texts = near_copies(2, 60)
    items = [" ".join(t.split()[5:40]) for t in texts[:20]] + ["", None, "a b", "w1", texts[3]]
    # Items of which some words are changed, inside a long document.
    changed = items[0].split()
    changed[len(changed) // 2 : len(changed) // 2 + 1] = ["other"]
    long = " ".join(WORDS * 5)
    docs = list(enumerate([*texts, long + " " + " ".join(changed) + " " + long, None, "", "a  B", "w1 w1"])) + [(None, texts[1]), (0, texts[0])]
    tests = list(enumerate(items))
    for limit in (4_000_000, 50):
        d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(tests, "item_id long, text string")
        got = sorted(((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in contained_items(d, b, limit=limit).collect()), key=str)
        assert got == brute(docs, tests)
        kept = [(r.doc_id, r.text) for r in decontaminate(d, b, limit=limit).collect()]
        bad = {text for text in {t for _, t in docs} if brute([(0, text)], tests)}
        assert sorted(kept, key=str) == sorted([r for r in docs if r[1] not in bad], key=str)


def test_items_shorter_than_a_shingle(spark):
    """Items of one to four words inside long documents, at their ends, and across what only looks like them."""
    draw = WORDS[:200]
    asked = ["capital of France", "paris", "one two", "a b c d", "to be or not to be"]
    docs = [
        (1, " ".join(draw[:100]) + " Capital  of\nFRANCE " + " ".join(draw[100:])),
        (2, "paris " + " ".join(draw)),
        (3, " ".join(draw) + " one two"),
        (4, "one\u00a0two two one capital of a b c"),
        (5, " ".join(draw[:50]) + " a b c d a b c d " + " ".join(draw[50:])),
        (6, "capital of france"),
        (7, "of"),
        (8, "x to be or not to be y"),
    ]
    items = list(enumerate(asked))
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert {(doc, item) for doc, item, *_ in want} == {(1, 0), (6, 0), (2, 1), (3, 2), (5, 3), (8, 4)}
    for limit in (4_000_000, 1):
        assert sorted(((r.doc_id, r.item_id, r.n_item, r.n_shared) for r in contained_items(d, b, limit=limit).collect()), key=str) == want
        assert sorted(r.doc_id for r in decontaminate(d, b, limit=limit).collect()) == [4, 7]


def test_other_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "x y z", "k", 5)], "doc_id long, text string, item_id string, shingles int")
    items = spark.createDataFrame([], "item_id long, text string")
    assert contained_items(docs, items).collect() == []
    assert decontaminate(docs, items).collect() == docs.collect()
    some = spark.createDataFrame([(1, "p q r s t u")], "item_id long, text string")
    assert decontaminate(docs, some).collect() == docs.collect()
    assert decontaminate(docs.where("false"), some).collect() == []
