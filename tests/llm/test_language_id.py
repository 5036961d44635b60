import random
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import TINY

from tapelake.llm import language_id

SCHEMA = "doc_id long, text string, lang string"
SIZE = 30


def grams(text):
    counts = Counter()
    for word in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split():
        padded = f" {word} "
        for n in (1, 2, 3):
            counts.update(padded[k : k + n] for k in range(len(padded) - n + 1))
    del counts[" "]
    return counts


def profile(counts, size):
    return [g for g, _ in sorted(counts.items(), key=lambda item: (-item[1], item[0]))[:size]]


def held_out(doc_id):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 4 == 2


def brute(rows, size):
    counts = defaultdict(Counter)
    for doc_id, text, lang in rows:
        if held_out(doc_id) is False and lang is not None and text is not None:
            counts[lang].update(grams(text))
    profiles = {lang: {g: k for k, g in enumerate(profile(c, size))} for lang, c in counts.items() if c}
    out = []
    for doc_id, text, _ in rows:
        mine = profile(grams(text), size)
        distances = sorted((sum(abs(p[g] - k) if g in p else size for k, g in enumerate(mine)), lang) for lang, p in profiles.items())
        if mine and distances:
            out.append((doc_id, held_out(doc_id), distances[0][1], round(1 - distances[0][0] / (len(mine) * size), 9)))
        else:
            out.append((doc_id, held_out(doc_id), "und", 0.0))
    return sorted(out, key=str)


def found(spark, rows, size=SIZE, schema=SCHEMA):
    documents = spark.createDataFrame(rows, schema)
    got = language_id.identify(documents, language_id.learn(documents, size), size).collect()
    return sorted(((r.doc_id, r.held_out, r.lang_pred, round(r.score, 9)) for r in got), key=str)


def rows_of(seed=5):
    draw = random.Random(seed)
    letters = {"aa": "abcdef", "bb": "defghé", "": "xyzß", "und": "漢字語"}
    rows = []
    for k in range(120):
        lang = draw.choice(list(letters))
        words = ["".join(draw.choice(letters[lang]) for _ in range(draw.randrange(1, 7))) for _ in range(draw.randrange(0, 30))]
        rows.append((k, draw.choice([" ", ", ", "\n", "1", "_", "²"]).join(words).title(), lang if k % 9 else None))
    rows += [(200, None, "aa"), (201, "", "aa"), (202, "12 34 ²³ !", "bb"), (None, "abc def", "aa"), (5, "abc abc", "aa"), (5, "abc abc", "aa")]
    return rows + [(300, "abcdef" * 2000, "aa"), (301, "abc def " * 3000, "aa")]


def test_against_brute_force(spark):
    rows = rows_of()
    assert found(spark, rows) == brute(rows, SIZE)


def test_pieces(spark, monkeypatch):
    rows = rows_of(6)
    for name, value in (("PIECE", 50), ("GRAMS", 20), ("LARGEST", 1 << 40)):
        monkeypatch.setattr(language_id, name, value)
    assert found(spark, rows) == brute(rows, SIZE)


def test_nothing_learned(spark):
    assert found(spark, []) == []
    assert {(r[2], r[3]) for r in found(spark, [(1, "some text", None), (2, None, "en")])} == {("und", 0.0)}


def test_labels_are_no_inputs(spark):
    rows = rows_of(7)
    documents = spark.createDataFrame(rows, SCHEMA)
    profiles = language_id.learn(documents, SIZE)
    wrong = spark.createDataFrame([(d, t, "zz") for d, t, _ in rows], SCHEMA)
    assert sorted(map(str, language_id.identify(documents, profiles, SIZE).collect())) == sorted(map(str, language_id.identify(wrong, profiles, SIZE).collect()))


def test_clashing_columns(spark):
    rows = [(k, "abc", "aa", "x", 0.5) for k in range(8)]
    assert {r[2] for r in found(spark, rows, schema=SCHEMA + ", lang_pred string, score double")} == {"aa"}


@pytest.mark.parametrize("part", [True, False])
def test_accuracy(spark, part):
    documents = spark.read.parquet(f"{TINY}/documents.parquet")
    got = language_id.identify(documents, language_id.learn(documents)).where(f"held_out = {part}")
    joined = got.join(documents.select("doc_id", "lang"), "doc_id").where("lang IS NOT NULL").collect()
    assert joined and sum(r.lang == r.lang_pred for r in joined) >= 0.99 * len(joined)
