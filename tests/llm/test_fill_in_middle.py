import hashlib
import random

import pytest

from tapelake.llm import fill_in_middle

SCHEMA = "doc_id long, text string"


def brute(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def rows_of(seed=3):
    draw = random.Random(seed)
    letters = "ab c\n<>PSMéßñ漢字🙂́\x00"
    rows = [(k, "".join(draw.choice(letters) for _ in range(draw.randrange(0, 40)))) for k in range(400)]
    rows += [(500, None), (501, ""), (502, "x<P>y"), (503, "<S>"), (504, "a<M"), (505, "<"), (None, "no id"), (7, "again"), (7, "again")]
    return rows + [(-600 - k, "<" * k + "P>é") for k in range(30)]


@pytest.mark.parametrize("block", [1 << 20, 5])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(fill_in_middle, "BLOCK", block)
    rows = rows_of()
    got = fill_in_middle.restore(fill_in_middle.transform(spark.createDataFrame(rows, SCHEMA).repartition(3))).collect()
    want = sorted((brute(*row) + (row[1] or "",) for row in rows), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_long_text_and_digests(spark):
    rows = [(k, "wörter " * (300_000 + k)) for k in range(3)]
    got = {r.doc_id: r for r in fill_in_middle.digests(spark.createDataFrame(rows, SCHEMA)).collect()}
    for doc_id, text in rows:
        want = brute(doc_id, text)
        r = got[doc_id]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == want[1:5]
        assert r.output_sha256 == hashlib.sha256(want[5].encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_rates(spark):
    docs = spark.range(300).selectExpr("id doc_id", "'some text here' text")
    forms = lambda **o: {r.form for r in fill_in_middle.transform(docs, **o).collect()}
    assert forms(rate=0) == {"plain"} and forms(rate=100, suffix_first=0) == {"psm"} and forms(rate=100, suffix_first=100) == {"spm"}
    one, other = ([r.output for r in fill_in_middle.transform(docs, seed=s).orderBy("doc_id").collect()] for s in (1, 2))
    assert one != other


def test_empty_and_clashing_columns(spark):
    rows = spark.createDataFrame([], SCHEMA + ", form string, output string, h1 int")
    assert fill_in_middle.digests(rows).collect() == []
    rows = spark.createDataFrame([(1, "text", "f", "o", 2)], SCHEMA + ", form string, output string, h1 int")
    assert fill_in_middle.restore(fill_in_middle.transform(rows)).first().restored == "text"


def test_broken_output(spark):
    rows = spark.createDataFrame([(1, 2, "psm", 1, 1, "<P>a<S>b")], fill_in_middle.OUTPUT)
    with pytest.raises(Exception, match="exactly once"):
        fill_in_middle.restore(rows).collect()
