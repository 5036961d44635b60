import random

import numpy as np
import pytest
import xxhash
from helpers import WORDS, Groups

from tapelake.llm import fuzzy_lines as lines
from tapelake.llm import queries


def distance(a, b):
    """Edit distance by whole rows."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(docs, least=lines.LEAST, bits=lines.DISTANCE, similarity=lines.SIMILARITY):
    found = []
    for doc, text in docs:
        for number, line in enumerate((text or "").split("\n")):
            (words,) = lines.normalised_lines(line.encode()) or [[]]
            if words:
                found.append((doc, number, b" ".join(words).decode()))
    long = sorted({norm for _, _, norm in found if len(norm) >= least})
    sims = lines.simhashes([norm.encode().split() for norm in long])
    groups = Groups()
    for a in range(len(long)):
        for b in range(a + 1, len(long)):
            if np.bitwise_count(sims[a] ^ sims[b]) <= bits:
                room = (1 - similarity) * max(len(long[a]), len(long[b]))
                if distance(long[a], long[b]) <= room + 1e-6:
                    groups.join(a, b)
    number = {norm: k for k, norm in enumerate(long)}
    group = {norm: groups.find(number[norm]) if norm in number else norm for _, _, norm in found}
    first = {}
    for doc, at, norm in sorted(found):
        first.setdefault(group[norm], (doc, at))
    return {(doc, at): first[group[norm]] for doc, at, norm in found}


def corpus(seed):
    draw = random.Random(seed)
    pool = [" ".join(draw.choice(WORDS) for _ in range(draw.randrange(2, 45))) for _ in range(40)]
    hot = [draw.choice(WORDS) for _ in range(60)]
    docs = []
    for k in range(70):
        body = []
        for _ in range(draw.randrange(5)):
            words = draw.choice(pool).split()
            if draw.random() < 0.4:
                words[draw.randrange(len(words))] = draw.choice(WORDS)
            body.append((" ".join(words)).capitalize() + draw.choice([".", "!", ""]))
        if k % 2:
            one = list(hot)
            one[draw.randrange(60)] = "other"
            body.append(" ".join(one))
        docs.append((k, "\n".join(body)))
    return docs + [(70, None), (71, ""), (72, "\n\n  \n"), (73, "x\nx\nx"), (74, "Ünïcode-line, with ÄÖ and 123 numbers\r\nünïcode line with äö and 456 numbers")]


@pytest.mark.parametrize("options", [{}, {"take": 2}, {"crowd": 1}, {"crowd": 2, "split": 6}, {"crowd": 0, "split": 3, "take": 3}])
def test_against_all_pairs(spark, options):
    docs = corpus(4)
    rows = lines.group_lines(spark.createDataFrame(docs, "doc_id long, text string"), **options).collect()
    want = brute(docs)
    assert {(r.doc_id, r.line_no): (r.first_doc_id, r.first_line_no) for r in rows} == want
    assert all(r.kept == ((r.doc_id, r.line_no) == (r.first_doc_id, r.first_line_no)) for r in rows)


def test_texts_left(spark):
    one, two, three = (" ".join(WORDS[k : k + 12]) for k in (0, 50, 100))
    rows = [
        (1, f"{one}\nshort\n\n{two}", "a", 7, 1),
        (2, f"{two.upper()}!\nshort\n{three}", "b", 7, 2),
        (3, one, "c", 7, 3),
        (None, f"{one}\nmine", "d", None, 4),
        (4, None, None, None, 5),
        (5, " ", "e", 1, 6),
        (6, f"{three}\n{three}", "f", 1, 7),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, tie string, n_chars long, doc int")
    got = {r.doc: (r.doc_id, r.text, r.tie, r.n_chars) for r in lines.dedup_lines(docs).collect()}
    assert got == {
        1: (1, f"{one}\nshort\n\n{two}", "a", 7),
        2: (2, three, "b", len(three)),
        4: (None, "mine", "d", 4),
        5: (4, None, None, None),
        6: (5, " ", "e", 1),
    }
    assert lines.dedup_lines(docs).columns == docs.columns
    assert lines.dedup_lines(docs.where("false")).collect() == []
    assert lines.group_lines(docs.where("doc_id = 4")).collect() == []
    twice = docs.where("doc_id = 3")
    assert lines.dedup_lines(twice.unionByName(twice)).count() == 2  # one document, given twice


def test_recall_of_edit_similarity(spark, monkeypatch):
    """Of the line pairs that reach the similarity, whatever their SimHashes, nine in ten get into one group."""
    draw = random.Random(11)
    lines_of, pairs = [], []
    for _ in range(300):
        words = [draw.choice(WORDS) + draw.choice(["", "en", "ing"]) for _ in range(draw.randrange(15, 60))]
        other = list(words)
        for _ in range(max(1, len(words) * draw.randrange(5, 16) // 100)):
            other[draw.randrange(len(other))] = draw.choice(WORDS)
        one, two = " ".join(words), " ".join(other)
        if one != two and distance(one, two) <= 0.2 * max(len(one), len(two)):
            pairs.append((len(lines_of), len(lines_of) + 1))
            lines_of += [one, two]
    assert len(pairs) > 200
    docs = spark.createDataFrame(list(enumerate(lines_of)), "doc_id long, text string")
    # As the registered query asks.
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    first = {r.doc_id: r.first_doc_id for r in queries.op4_fuzzy_line_dedup(spark, "").collect()}
    assert sum(first[a] == first[b] for a, b in pairs) >= 0.9 * len(pairs)


def test_equal_short_lines(spark, monkeypatch):
    """Equal short lines keep one occurrence, different ones all stay, however alike."""
    one = " ".join(WORDS[:12])
    texts = ["Read more\nshort\n\n" + one, "read MORE!\nshorts\n" + one, "x\nx\nown", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    got = {(r.doc_id, r.line_no): (r.first_doc_id, r.first_line_no, r.kept) for r in queries.op4_fuzzy_line_dedup(spark, "").collect()}
    assert got == {
        (0, 0): (0, 0, True), (0, 1): (0, 1, True), (0, 3): (0, 3, True),
        (1, 0): (0, 0, False), (1, 1): (1, 1, True), (1, 2): (0, 3, False),
        (2, 0): (2, 0, True), (2, 1): (2, 0, False), (2, 2): (2, 2, True),
    }
    left = {r.doc_id: r.text for r in lines.dedup_lines(docs).collect()}
    assert left == {0: texts[0], 1: "shorts", 2: "x\nown", 3: None}


def test_wide_runs(monkeypatch):
    draw = np.random.default_rng(3)
    run = draw.integers(0, 2**63, 400, dtype=np.uint64) & np.uint64(0x00FFFFFFFFFFFF00)
    run[200:] = run[:200] ^ (np.uint64(1) << draw.integers(8, 56, 200, dtype=np.uint64)) ^ (np.uint64(1) << draw.integers(8, 56, 200, dtype=np.uint64))
    size = np.sort(draw.integers(20, 26, 400, dtype=np.int32))
    order = draw.permutation(400)
    run = run[order]
    want = {(i, j) for i in range(400) for j in range(i + 1, 400) if np.bitwise_count(run[i] ^ run[j]) <= 10 and 10 * (size[j] - size[i]) <= 2 * size[j]}
    monkeypatch.setattr(lines, "TILE", (7, 30))
    for wide in (50, 1000):
        monkeypatch.setattr(lines, "WIDE_RUN", wide)
        got = [(int(a), int(b)) for i, j in lines._near_in_run(run, size, 10, 0.8) for a, b in zip(i, j, strict=True)]
        assert len(want) >= 150 and len(got) == len(set(got)) and set(got) == want


def test_edit_distance():
    draw = random.Random(9)
    for _ in range(300):
        x = "".join(draw.choice("abcé") for _ in range(draw.randrange(70)))
        y = "".join(c for c in x if draw.random() < 0.8) + draw.choice(["", "b", "aé"])
        assert lines.edit_distance(x, y) == distance(x, y)
        assert lines.alike(x, y, 0.8) == (distance(x, y) <= 0.2 * max(len(x), len(y)) + 1e-6)


def test_buckets_of_one_block_tell_each_pair(monkeypatch):
    """Long runs leave out pairs that another block's bucket tells; together they tell every near pair, comparing few."""
    draw = np.random.default_rng(5)
    sims = draw.integers(0, 2**64, 3000, dtype=np.uint64)
    for k in range(1, 1500):
        bits = draw.choice(64, draw.integers(0, 14), replace=False)
        sims[k] = sims[draw.integers(1500, 3000)] ^ np.bitwise_or.reduce(np.uint64(1) << bits.astype(np.uint64), initial=np.uint64(0))
    edges = [64 * k // 11 for k in range(12)]
    ones = np.uint64(sum(1 << at for at in edges[:10]))  # one bit in each of the blocks but the last
    sims[0] = sims[2000] ^ ones
    size = np.sort(draw.integers(100, 132, 3000, dtype=np.int32))
    near = np.bitwise_count(sims[:, None] ^ sims) <= 10
    want = {(i, j) for i, j in zip(*np.nonzero(np.triu(near, 1)), strict=True) if 10 * (size[j] - size[i]) <= 2 * size[j]}
    monkeypatch.setattr(lines, "WIDE_RUN", 8)
    got = []
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        block = (sims >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)
        for value in np.unique(block):
            rows = np.flatnonzero(block == value)
            for i, j in lines._near_in_run(sims[rows], size[rows], 10, 0.8, first=True):
                got += zip(rows[i].tolist(), rows[j].tolist(), strict=True)
    assert (0, 2000) in want and len(want) > 500 and set(got) == want


def test_bucket_keys_of_different_blocks_differ(spark):
    draw = np.random.default_rng(6)
    sims = spark.createDataFrame([(int(x),) for x in draw.integers(-(2**63), 2**63, 400)], "sim long")
    for take in (1, 2):
        keys = list(zip(*(r[0] for r in sims.select(lines.bucket_keys(sims["sim"], 10, take)).collect()), strict=True))
        assert sum(len(set(part)) for part in keys) == len(set().union(*keys))


def test_simhashes_of_many_lines():
    """As by a set of words and a hash for each, one line at a time."""
    draw = random.Random(12)
    letters = ["a", "b", "0", "é", "字"]
    found = [[("".join(draw.choice(letters) for _ in range(draw.choice([1, 2, 3, 5, 8, 13, 31, 40])))).encode() for _ in range(draw.randrange(30))] for _ in range(200)]
    found.append([str(k).encode() for k in range(700)])
    for words, sim in zip(found, lines.simhashes(found).tolist(), strict=True):
        hashes = [xxhash.xxh64_intdigest(word) for word in set(words)]
        plain = sum(1 << at for at in range(64) if 2 * sum(h >> at & 1 for h in hashes) > len(hashes))
        assert sim == plain
    texts = [b" The  Quick-Brown 42\t\n\n A", b"!", "Ünï-code \r\n  x ".encode(), b"\n"]
    assert lines._whole_lines(texts) == [b" ".join(words) for text in texts for words in lines.normalised_lines(text)]


def test_edit_distances_of_many_pairs():
    draw = random.Random(10)
    xs = ["".join(draw.choice("abcé字") for _ in range(draw.randrange(200))) for _ in range(400)] + ["", "", "abc"]
    ys = ["".join(c for c in x if draw.random() < draw.choice([0.7, 0.9, 0.99])) + draw.choice(["", "b", "aé"]) for x in xs[:400]] + ["", "ab", ""]
    want = [distance(x, y) for x, y in zip(xs, ys, strict=True)]
    assert lines.edit_distances(xs, ys, 300).tolist() == want
    for room in (0, 3, 20):
        told = lines.edit_distances(xs, ys, room).tolist()
        one = [lines.edit_distance(x, y, room) for x, y in zip(xs, ys, strict=True)]
        assert all(min(a, room + 1) == min(b, room + 1) == min(c, room + 1) for a, b, c in zip(told, one, want, strict=True))
    alike = [d <= 0.2 * max(len(x), len(y)) + 1e-6 for x, y, d in zip(xs, ys, want, strict=True)]
    assert lines.all_alike(xs, ys, 0.8).tolist() == alike and 50 < sum(alike) < 350
    assert lines.all_alike([], [], 0.8).tolist() == []


def test_pieces():
    assert lines.normalised_lines("The  Quick-Brown 42\tÄ_b\n\nA".encode()) == [[b"the", b"quick", b"brown", b"00", "ä".encode(), b"b"], [], [b"a"]]
    assert lines.normalised_lines(None) == []
    assert lines.choose_take(100) == 1 and lines.choose_take(10**9) > 1
    assert lines.simhashes([[]]).tolist() == [0]
