import numpy as np
from helpers import words_of

from tapelake.llm import mixing


def want_targets(sizes):
    """Targets by sharing again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    held = {}
    while True:
        rest = sum(sizes.values()) - sum(held.values())
        open_ = sum(w for s, w in weight.items() if s not in held)
        share = {s: rest * w / open_ for s, w in weight.items() if s not in held}
        over = {s: 3 * sizes[s] for s, t in share.items() if t >= 3 * sizes[s]}
        if not over:
            return share | held
        held |= over


def rows_of(counts):
    docs, number = [], 0
    for source, sizes in counts.items():
        for size in sizes:
            docs.append((number, " ".join(f"{number}_{k}" for k in range(size)), source, "x"))
            number += 1
    return docs


COUNTS = {"b": [500, 0, 37, 1200], "a": [10], "é": [3, 4, 5] * 30, "z": [70] * 20, None: [11, 2], "": [0], "Z": [9000]}
SCHEMA = "doc_id long, text string, source string, target string"


def test_targets_and_taken(spark):
    docs = rows_of(COUNTS)
    table = spark.createDataFrame(docs, SCHEMA)
    sizes = {s: sum(c) for s, c in COUNTS.items()}
    want = want_targets(sizes)
    for block in (256, 7):
        got = {r.doc_id: r for r in mixing.mix(table, block=block, shard_slots=50).collect()}
        taken = dict.fromkeys(sizes, 0)
        for number, text, source, _ in docs:
            row = got[number]
            assert row.size == len(words_of(text)) and row.source_size == sizes[source] and abs(row.target - want[source]) < 1e-6
            assert 0 <= row.taken <= 3 * row.size
            taken[source] += row.taken
        assert all(abs(taken[s] - want[s]) <= 0.5 + 1e-6 for s in sizes)
        again = {r.doc_id: r.taken for r in mixing.mix(table.repartition(7), block=block, shard_slots=50).collect()}
        assert again == {d: r.taken for d, r in got.items()}


def test_texts(spark):
    table = spark.createDataFrame(rows_of(COUNTS), SCHEMA)
    taken = {r.doc_id: r.taken for r in mixing.mix(table, block=16, shard_slots=20).collect()}
    rows = mixing.mixed_texts(table, block=16, shard_slots=20).collect()
    words = {}
    for r in rows:
        for word in r.text.split(" "):
            assert word.startswith(f"{r.doc_id}_")
            words[r.doc_id] = words.get(r.doc_id, 0) + 1
    assert words == {d: n for d, n in taken.items() if n}
    # Blocks of one pass differ, and no slot is longer than a block.
    slots = {}
    for r in rows:
        slots.setdefault((r.source, r.slot), []).append((r.place, len(r.text.split(" "))))
    assert all(sum(n for _, n in parts) <= 16 for parts in slots.values())
    assert len({r.shard for r in rows}) > 1


def test_odd_rows(spark):
    rows = [(1, None, "a", ""), (1, "x y", "a", ""), (1, "x y", "a", ""), (None, "p q\x0br s", None, "")]
    got = sorted((str(r.doc_id), r.size, r.source_size, r.target, r.taken) for r in mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect())
    assert [g[:3] for g in got] == [("1", 0, 4), ("1", 2, 4), ("1", 2, 4), ("None", 3, 3)]
    assert sum(g[4] for g in got) == 7
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(empty).collect() == [] and mixing.mixed_texts(empty).collect() == []
    nothing = spark.createDataFrame([(1, "", "a", ""), (2, None, "b", "")], SCHEMA)
    assert [(r.size, r.source_size, r.target, r.taken) for r in mixing.mix(nothing).collect()] == [(0, 0, 0.0, 0)] * 2


def test_permutation():
    for count in (1, 2, 3, 64, 65, 1000):
        images = mixing.permuted(np.arange(count), count, 12345678901234567890)
        assert sorted(images) == list(range(count))
    assert mixing.permuted(np.arange(100), 100, 1).tolist() != mixing.permuted(np.arange(100), 100, 2).tolist()
