import pytest

from tidemark.llm import queries, url_filter

CASES = {
    "http://example.org/es/1": ("example.org", "/es/1", "example.org/es/", "block"),
    "http://EXAMPLE.org/en/12?x=/es/": ("example.org", "/en/12", "example.org/en/1", "block"),
    "http://a.b.example.org/en/2": ("a.b.example.org", "/en/2", "org/", "allow"),
    "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
    "https://x.com/de/?q": ("x.com", "/de/", "com/de/", "block"),
    "https://x.com/fr/#a": ("x.com", "/fr/", "com/fr/", "allow"),
    "https://x.com": ("x.com", "", None, "allow"),
    "https://x.org?y://z": ("x.org", "", None, "allow"),
    "https://x.org:80/": ("x.org:80", "/", None, "allow"),
    "no scheme.org/": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
    "x://" + "a." * 300 + "com/de/" + "p" * 5000: ("a." * 300 + "com", "/de/" + "p" * 5000, "com/de/", "block"),
}


def test_rules(spark):
    rows = [(i, u, "clash", "clash") for i, u in enumerate(CASES)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    got = url_filter.filter_urls(pages, queries.URL_RULES).collect()
    assert len(got) == 2 * len(CASES)
    for row in got:
        assert (row.host, row.path, row.rule, row.verdict) == list(CASES.values())[row.page_id]


def test_collisions_are_settled_by_the_string(monkeypatch, tmp_path):
    monkeypatch.setattr(url_filter, "digest", lambda text: len(text))
    url_filter.DigestArray.write(str(tmp_path / "d"), {"ab": 1, "cd": 2, "e": 3})
    array = url_filter.DigestArray(str(tmp_path / "d"))
    assert array.find(["ab", "cd", "xx", "e", "f", ""]) == [1, 2, None, 3, None, None]


def test_no_rules_and_no_rows(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.filter_urls(empty, queries.URL_RULES).collect() == []
    one = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    assert url_filter.filter_urls(one, [], otherwise="block").first().verdict == "block"


def test_a_list_beyond_the_bound_is_refused(spark):
    one = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    with pytest.raises(ValueError):
        url_filter.filter_urls(one, queries.URL_RULES, most=2)
