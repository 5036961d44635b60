import pytest

from tapelake.llm.url_rules import judge

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
CASES = [
    ("http://a.net/", "a.net", "/", "net/", "block"),
    ("http://a.net", "a.net", "", None, "allow"),
    ("https://WWW.Example.NET/en/x?y#z", "www.example.net", "/en/x", "example.net/en/", "allow"),
    ("https://example.net/EN/", "example.net", "/EN/", "net/", "block"),
    ("x://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
    ("x://a.example.com/de/1/2/", "a.example.com", "/de/1/2/", "example.com/de/", "block"),
    ("x://a.example.com/de", "a.example.com", "/de", None, "allow"),
    ("x://.org/fr/", ".org", "/fr/", "org/fr/", "allow"),
    ("x://q?a/b", "q", "", None, "allow"),
    ("nothing", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("x://", "", "", None, "allow"),
    ("a://b://c/", "b:", "//c/", None, "allow"),
    ("x://" + "a." * 3000 + "net/" + "p/" * 3000, "a." * 3000 + "net", "/" + "p/" * 3000, "net/", "block"),
]


def rules(spark, rows=RULES):
    return spark.createDataFrame(rows, "host string, path string, verdict string")


def test_cases(spark):
    rows = [(k, case[0], "x") for k, case in enumerate(CASES)] + [(0, CASES[0][0], "again"), (None, CASES[0][0], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string")
    got = sorted((tuple(r) for r in judge(pages, rules(spark)).collect()), key=str)
    want = [(k, *case[1:]) for k, case in enumerate(CASES)] + [(0, *CASES[0][1:]), (None, *CASES[0][1:])]
    assert got == sorted(want, key=str)


def test_longest_rule(spark):
    pages = spark.createDataFrame([(1, "x://a.b/c/d")], "page_id long, url string")
    more = [("b", "/c/", "block"), ("a.b", "/", "allow"), ("a.b", "/c/", "allow"), ("A.b", "/c/", "block")]
    (row,) = judge(pages, rules(spark, more)).collect()
    assert (row.rule, row.verdict) == ("a.b/c/", "block")


def test_empty_and_refused(spark):
    pages = spark.createDataFrame([(1, "x://a.net/")], "page_id long, url string")
    assert [r.verdict for r in judge(pages, rules(spark, [])).collect()] == ["allow"]
    assert judge(pages.where("false"), rules(spark)).collect() == []
    for bad in [("a", "x", "block"), ("", "/", "block"), ("a", "/", "no"), (None, "/", "allow")]:
        with pytest.raises(ValueError):
            judge(pages, rules(spark, [bad]))
