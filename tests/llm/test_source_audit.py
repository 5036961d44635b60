import re
from collections import Counter, defaultdict

from tapelake.llm import source_audit

SCHEMA = "text string, lang string, source string"
PATTERN = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=3, top=200):
    rows = [tuple(v or "" for v in row) for row in rows]
    split = [([t.translate(LOWER) for t in PATTERN.findall(text)], lang, source) for text, lang, source in rows]
    out = set()
    for lang in {lang for _, lang, _ in split}:
        mine = [(words, source) for words, of, source in split if of == lang]
        docs = Counter(t for words, _ in mine for t in set(words))
        kept = sorted(t for t, n in docs.items() if n >= least)
        counts, whole = defaultdict(Counter), Counter()
        for words, source in mine:
            counts[source].update(t for t in words if docs[t] >= least)
            whole.update(t for t in words if docs[t] >= least)

        def p(c, kept=kept):
            total = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 1) // (total + len(kept)) for t in kept}

        probable = {source: p(c) for source, c in counts.items()}
        q = p(whole)
        for a in probable:
            pairs = [(b, sum((probable[a][t] - probable[b][t]) ** 2 // probable[b][t] for t in kept)) for b in probable if b != a]
            terms = [(t, (probable[a][t] - q[t]) ** 2 // q[t]) for t in kept if counts[a][t] and probable[a][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda r: (-r[1], r[0].encode()))
                out |= {(lang, a, part, item, value, k) for k, (item, value) in enumerate(found[: top if part == "term" else None], 1)}
    return out


def found(spark, rows, **options):
    return {tuple(r) for r in source_audit.audit(spark.createDataFrame(rows, SCHEMA), **options).collect()}


def test_against_brute_force(spark):
    rows = [(f"The {'cat' if k % 3 else 'DOG'} sat, on-{k % 7} mats é{'Ñ' * (k % 2)} {'x ' * (k % 5)}", "en" if k % 4 else "de", f"s{k % 5}") for k in range(60)]
    rows += [(None, "en", "s1"), ("", "en", "only empty"), ("cat cat", None, None), ("cat", "", None), ("cat", None, ""), ("1 2 3", "xx", "a"), ("one", "xx", "b")]
    want = brute(rows)
    assert found(spark, rows) == want
    assert {r[3:5] for r in want if r[0] == "xx" and r[2] == "pair"} == {("a", 0), ("b", 0)}


def test_ties_and_top(spark):
    rows = [("b a é z", "en", "x")] * 3 + [("q q q q q", "en", "y")] * 3
    assert found(spark, rows, top=2) == brute(rows, top=2)


def test_pieces(spark, monkeypatch):
    rows = [("alpha beta " * 50 + "gamma", "en", f"s{k}") for k in range(9)] + [("delta beta", "en", "s1")] * 4
    want = found(spark, rows)
    for name in ("PIECE", "HELD", "PAIRS"):
        monkeypatch.setattr(source_audit, name, 7)
    assert found(spark, rows) == want == brute(rows)


def test_large_counts(spark):
    one = spark.range(1).selectExpr("9000000000000000 n", "9000000000000000000 total", "5L terms")
    n, total, terms = 9 * 10**15, 9 * 10**18, 5
    assert one.select(source_audit.probability(one.n, one.total, one.terms)).first()[0] == 1 + 10**9 * (n + 1) // (total + terms)


def test_empty_and_clashing_columns(spark):
    assert found(spark, []) == set()
    rows = spark.createDataFrame([("cat", "en", "a", 1, "x")] * 3, SCHEMA + ", n long, term string")
    assert [tuple(r) for r in source_audit.audit(rows).collect()] == []
