from __future__ import annotations

import math
import re
from pathlib import PurePosixPath
from urllib.parse import quote, urlparse

from pyspark.sql import functions as F

from corpusloom.functions import text as X


def values(spark, data, *exprs):
    return [tuple(r) for r in spark.createDataFrame([(x,) for x in data], "v string").select(*exprs).collect()]


def test_strip_as_python(spark):
    data = ["\t a \r\n", " b ", "\x1cc\x1f", "", "  ", None, "d e"]
    assert [r[0] for r in values(spark, data, X.clean("v"))] == [(x or "").strip() for x in data]


def test_urls_as_urllib(spark):
    data = ["https://h.x/a/b c.pdf", "http://h/%20x.PDF?q=1/2#f/g", "https://h/(S(1))/y.pdf;p=1", "https://h.x/dir/", "no/scheme.tar.gz", "", "x.pdf?v=1", "https://H.X:80/a//b/?x", "file.pdf#s"]
    got = values(spark, data, X.url_basename("v"), X.url_host("v"), X.stem(X.url_basename("v")), X.is_pdf_path("v"), X.is_pdf_url("v"))
    for x, (base, host, stem, path_pdf, url_pdf) in zip(data, got):
        p = urlparse(x)
        assert base == PurePosixPath(p.path).name and host == p.netloc.lower() and stem == PurePosixPath(base).stem
        assert path_pdf == p.path.lower().endswith(".pdf") and url_pdf == x.lower().endswith(".pdf")


def test_stems(spark):
    assert [r[0] for r in values(spark, [".pdf", "a.tar.gz", "UPPER.PDF", "plain"], X.stem("v"))] == [".pdf", "a.tar", "UPPER", "plain"]


def test_slug(spark):
    def slug(v):
        return re.sub("-{2,}", "-", re.sub("[^a-z0-9]+", "-", v.lower())).strip("-") or "untitled"

    data = ["A b", " ! ", "--x--", "É t", "", "a_b"]
    assert [r[0] for r in values(spark, data, X.slug("v"))] == [slug(x) for x in data]


def test_is_float_as_python(spark):
    def ok(v):
        try:
            float(v)
        except ValueError:
            return False
        return True

    data = ["12", "1e3", "1.5d", "1_000", "nan", "", " 7 ", ".5", "5.", "+1", "--1", "1__0", "inf", "0x1", "1e", "-Infinity", "_1"]
    assert [r[0] for r in values(spark, data, X.is_float("v"))] == [ok(x) for x in data]


def test_percent_encoding_as_urllib(spark):
    data = ["a b(c)'&,-._~*+/é%", "x"]
    assert [r[0] for r in values(spark, data, X.percent_encode("v"))] == [quote(x, safe="'()&,-._") for x in data]


def test_numbers_and_decades(spark):
    got = values(spark, ["1999abc", "", "0", "1987", " 42", "x"], X.js_int("v"), X.decade("v"), X.py_int("v"))
    assert got == [(1999, "1990s", 0), (None, "Unknown", 0), (0, "0s", 0), (1987, "1980s", 1987), (42, "40s", 42), (None, "Unknown", 0)]
    assert [r[0] for r in values(spark, ["2025.0", "nan", None, "Part 2.0", "7"], X.clean_number("v"))] == ["2025", "", "", "Part 2.0", "7"]


def test_title_case_and_issue(spark):
    assert [r[0] for r in values(spark, ["a_b o'c d-e", "ABC def"], X.title_case("v"))] == [x.title() for x in ["a_b o'c d-e", "ABC def"]]
    assert [r[0] for r in values(spark, ["J-1-1966-issue-3", "J", None], X.issue_number("v"))] == [3, 0, 0]
    assert [r[0] for r in values(spark, ["J-49-2014-Issue-2", "none"], X.year_token("v"))] == ["2014", None]


def test_highlight(spark):
    assert values(spark, ["a<b> Ab & c"], X.highlight("v", "b c"), X.highlight("v", "(", True), X.highlight("v", "^a", True))[0] == ("a&lt;<mark>b</mark>&gt; A<mark>b</mark> &amp; <mark>c</mark>", "a&lt;b&gt; Ab &amp; c", "<mark>a</mark>&lt;b&gt; Ab &amp; c")


def test_size_text_halves_up(spark):
    rows = spark.createDataFrame([(1024.0, "pdf"), (1075.2, "pdf"), (0.0, "pdf"), (5.0, "link")], "s double, t string")
    want = [f"{math.floor(s / 1024 * 10 + 0.5) / 10:g} MB" if t != "link" else "" for s, t in ((1024, "pdf"), (1075.2, "pdf"), (0, "pdf"), (5, "link"))]
    assert [r[0] for r in rows.select(X.size_text("s", "t")).collect()] == want


def test_small_ones(spark):
    got = values(spark, ["x" * 29, "a#b c", "```json\n{\"a\":1}\n```"], X.short_label("v"), X.css_token("v"), X.fenced_json("v"), X.escape_attribute(F.lit('<"&>')))
    assert got[0][0] == "x" * 26 + "..." and got[1][1] == "cat-a-b-c" and got[2][2] == '{"a":1}' and got[0][3] == "&lt;&quot;&amp;&gt;"
