import math
import re

import pytest

from tapelake.llm import license_scan as scan


def brute(files):
    words_of = lambda text: re.findall(r"[^\W_]+", (text or "").lower())
    total = len(files)
    have = {}
    for _, _, text in files:
        for word in set(words_of(text)):
            have[word] = have.get(word, 0) + 1
    known = {w for _, text in scan.TEMPLATES for w in words_of(text)}
    idf = lambda w: math.log((1 + total) / (1 + have.get(w, 0) * (w in known))) + 1

    def vector(words):
        return {w: words.count(w) * idf(w) for w in words}

    def best(text):
        unit, out = vector(words_of(text)), (0.0, "")
        for name, template in scan.TEMPLATES:
            other = vector(words_of(template))
            dot = sum(unit.get(w, 0) * x for w, x in other.items())
            length = math.sqrt(sum(x * x for x in unit.values()) * sum(x * x for x in other.values()))
            score = round(dot / length, 6) if dot else 0.0
            if score > out[0] or score == out[0] and score and name < out[1]:
                out = (score, name)
        return out

    own, told = {}, {}
    for key, path, text in files:
        scores = [s for s in map(best, (text or "").split("\n")) if s[0] >= scan.LINE_COSINE]
        top = max(scores, key=lambda s: s[0]) if scores else None
        own[key] = top
        whole = best(text)
        if path and "/" in path and (whole[0] >= scan.FILE_COSINE or top and re.match(scan.NAMES, path.split("/")[-1])):
            hit = max([whole, *([top] if top else [])], key=lambda s: s[0])
            told.setdefault(path.rpartition("/")[0], []).append((-hit[0], hit[1]))
    out = []
    for key, path, _ in files:
        above, from_ = None, None
        if not own[key] and path and "/" in path:
            steps = path.split("/")[:-1]
            for depth in range(len(steps), 0, -1):
                if "/".join(steps[:depth]) in told:
                    from_ = "/".join(steps[:depth])
                    above = min(told[from_])[1]
                    break
        out.append((key, own[key][1] if own[key] else None, own[key][0] if own[key] else None, own[key][1] if own[key] else above, from_))
    return sorted(out, key=str)


FILES = [
    (1, "a/LICENSE", "Copyright someone\nLicensed under the Apache License, Version 2.0.\n" + "words " * 400),
    (2, "a/b/c/x.py", "import os\n"),
    (3, "a/b/COPYING.txt", "Released under the MIT license"),
    (4, "a/b/y.py", "# This work is licensed under the GNU General Public License version 3\ncode"),
    (5, "a/z.py", None),
    (6, "top.py", "nothing"),
    (7, None, "All rights reserved."),
    (8, "d/e", ""),
    (9, "d/notes", "the of and license terms of the version under which all is licensed in the end of it"),
    (10, "a/b/c/d/e/f.py", "Licensed under CC BY-SA 4.0. Licensed under CC BY 4.0."),
    (11, "q/licence", "Licensed under CC BY 4.0.\nLicensed under CC BY-NC 4.0.\n"),
    (12, "q/licence", "Licensed under CC BY 4.0.\nLicensed under CC BY-NC 4.0.\n"),
    (13, "q//x", "x"),
    (14, "/abs/x", "licensed " * 5000),
]


@pytest.mark.parametrize("files", [FILES, FILES * 2, FILES[:1], [(100 + k, f"s{k % 3}/{k}", "words and words") for k in range(50)] + FILES])
def test_against_brute_force(spark, files):
    table = spark.createDataFrame([(*f, "x", 1) for f in files], "file_id long, path string, text string, license string, tie int")
    got = scan.scan(table).collect()
    assert sorted(((r.file_id, r.own_license, r.own_score, r.license, r.from_directory) for r in got), key=str) == brute(files)


def test_empty(spark):
    assert scan.scan(spark.createDataFrame([], "file_id long, path string, text string")).collect() == []
    docs = spark.createDataFrame([(1, None, None, None), (None, "Released under the MIT License.", "de", "s")], "doc_id long, text string, lang string, source string")
    got = {r.file_id: r.path for r in scan.document_files(docs).collect()}
    assert got == {1: "unknown/unknown/0/1.txt", None: None}
    assert scan.scan(scan.document_files(docs)).count() == 2


def test_anchors_lose_nothing():
    counts = scan.template_words(scan.TEMPLATES)
    vectors, idf, _ = scan.weights(counts, 1000, {"the": 900, "license": 40, "of": 800})
    chosen = scan.anchors(vectors, idf, 0.6)
    assert all(math.sqrt(sum(v * v for w, v in vector.items() if w not in chosen)) < 0.6 for vector in vectors)
    assert "the" not in chosen


def test_texts_of_licence_files(spark):
    """A document that is a whole licence text has that licence and gives it to its folder."""
    texts = dict(scan.TEXTS)
    rows = [(k, f"prose number {k} about the work of others and the use of things", "en", "web") for k in range(40)]
    rows += [(1000, "Copyright 2024 Some One\n\n" + texts["MIT"], "en", "web"), (1001, "nothing here", "en", "web")]
    rows += [(2000, texts["Apache-2.0"].replace("\n", " "), "en", "web"), (2001, "nor here", "en", "web")]
    rows += [(3000, texts["GPL-3.0"], "en", "web"), (3001, None, "en", "web")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.file_id: (r.own_license, r.license) for r in scan.scan(scan.document_files(docs)).collect()}
    assert [got[k] for k in (1000, 1001)] == [("MIT", "MIT"), (None, "MIT")]
    assert [got[k] for k in (2000, 2001)] == [("Apache-2.0", "Apache-2.0"), (None, "Apache-2.0")]
    assert [got[k] for k in (3000, 3001)] == [("GPL-3.0", "GPL-3.0"), (None, "GPL-3.0")]
    assert all(got[k] == (None, None) for k in range(40))


def test_least_words_lose_nothing():
    """No set of fewer words of a text is as long as the threshold, and the longest set of that many is."""
    counts = scan.template_words(scan.TEXTS)
    vectors, _, _ = scan.weights(counts, 1000, {"the": 900, "license": 40, "of": 800, "software": 300})
    for vector in vectors:
        least = scan.least_words(vector, scan.TEXT_COSINE)
        values = sorted(vector.values(), reverse=True)
        assert math.sqrt(sum(v * v for v in values[: least - 1])) < scan.TEXT_COSINE <= math.sqrt(sum(v * v for v in values[:least])) + 1e-6
        assert 1 < least < len(vector)


def test_texts_by_cosine_alone(spark):
    """Parts of licence texts of all lengths: those that reach the cosine are found, and no others."""
    words_of = lambda text: re.findall(r"[^\W_]+", (text or "").lower())
    texts = scan.TEXTS
    files = [(100 + k, f"s{k}/x", f"the work of others number {k} and the use of it") for k in range(30)] + [(1, "a/b", None), (2, "a/c", "")]
    for k, (_, text) in enumerate(texts):
        words = text.split()
        for j, share in enumerate((0.2, 0.35, 0.5, 0.65, 0.8, 1.0)):
            files.append((1000 + 10 * k + j, f"t{k}/{j}/x", " ".join(words[: int(len(words) * share)]) + " plain words besides" * (5 * j)))
    total, known = len(files), {w for _, text in texts for w in words_of(text)}
    have = {}
    for _, _, text in files:
        for word in set(words_of(text)) & known:
            have[word] = have.get(word, 0) + 1

    def vector(words):
        return {w: words.count(w) * (math.log((1 + total) / (1 + have.get(w, 0))) + 1) for w in set(words)}

    expected = {}
    for key, _, text in files:
        unit, scores = vector(words_of(text)), []
        for name, other in texts:
            side = vector(words_of(other))
            dot = sum(unit.get(w, 0) * x for w, x in side.items())
            score = dot / math.sqrt(sum(x * x for x in unit.values()) * sum(x * x for x in side.values())) if dot else 0.0
            scores.append((-round(score, 6), name))
        score, name = min(scores)
        expected[key] = (-score, name) if -score >= scan.TEXT_COSINE else None
    got = scan.scan(spark.createDataFrame(files, "file_id long, path string, text string"), templates=[("X", "qqqq zzzz")]).collect()
    assert {r.file_id: (r.own_score, r.own_license) if r.own_license else None for r in got} == expected
    assert 9 < sum(hit is not None for hit in expected.values()) < 50
