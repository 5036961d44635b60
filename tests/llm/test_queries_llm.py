"""The registered queries against their SQL twins, and the pipeline against brute force."""

import pytest
from conftest import TINY
from helpers import jaccard_components, shingles, words_of
from test_contamination import brute as contaminated
from test_lines import brute as grouped_lines

import corpus_pipeline
from tapelake.llm import toxicity
from tapelake.llm.oracles import ORACLES
from tapelake.llm.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{TINY}/{name}.parquet')")
    return con


def plain(rows):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in rows), key=str)


@pytest.mark.parametrize("name", [name for name in QUERIES if name in ORACLES])
def test_twin(spark, duck, name):
    got = QUERIES[name](spark, TINY)
    columns = sorted(got.columns)
    want = duck.execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]})")
    assert plain(tuple(r) for r in got.select(*columns).collect()) == plain(want.fetchall())


def test_all_operators():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{TINY}/benchmark.parquet").collect()]
    steps = dict(corpus_pipeline.STAGES)

    kept = corpus_pipeline.stage(steps["toxicity"](spark, docs, TINY), "t")
    model = toxicity.learn(docs, spark.read.parquet(f"{TINY}/labels.parquet"))
    fine = {r.doc_id for r in toxicity.score(docs, model).collect() if not r.predicted}
    assert kept.columns == columns and {r.doc_id: r for r in kept.collect()} == {d: rows[d] for d in fine}

    left = corpus_pipeline.stage(steps["line_dedup"](spark, kept, TINY), "l")
    first = grouped_lines([(d, rows[d].text) for d in sorted(fine)])
    want = {}
    for d in fine:
        text = rows[d].text
        stays = [line for k, line in enumerate(text.split("\n")) if first.get((d, k), (d, k)) == (d, k)]
        if "\n".join(stays) == text or "".join(stays).strip():
            want[d] = "\n".join(stays)
    got = {r.doc_id: r for r in left.collect()}
    assert left.columns == columns and {d: r.text for d, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())

    single = corpus_pipeline.stage(steps["ngram_jaccard_join"](spark, left, TINY), "j")
    found = jaccard_components(list(want.items()))
    alone = {d for d, (_, first_doc) in found.items() if d == first_doc}
    assert single.columns == columns and {r.doc_id for r in single.collect()} == alone

    clean = corpus_pipeline.stage(steps["benchmark_decontamination"](spark, single, TINY), "c")
    bad = {d for d, *_ in contaminated([(d, want[d]) for d in alone], items)}
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == alone - bad

    mixed = steps["mixing_sources"](spark, clean, TINY).collect()
    assert {r.doc_id: r.size for r in mixed} == {d: len(words_of(want[d])) for d in alone - bad}
    assert shingles("") == set()
    assert {r.doc_id for r in corpus_pipeline.run(spark, TINY).collect()} == alone - bad
