from __future__ import annotations

import random

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from corpusloom.operators import diff, identity, legacy, registry, search
from corpusloom.settings import Settings
from corpusloom.sources import readers
from corpusloom.sources.readers import SearchRequest


def test_contains_and_suffix_registry(spark):
    rows = spark.createDataFrame([(1, "https://h/Vol11.pdf"), (2, "https://h/1.pdf"), (3, None), (4, "1.pdf")], "id int, url string")
    entries = spark.createDataFrame([("1.pdf",), ("$",)], "entry string")
    assert [r["affiliated"] for r in registry.flagged(rows, entries, ["url"]).orderBy("id").collect()] == [True, True, False, True]
    assert [r["affiliated"] for r in registry.suffix_flagged(rows, entries, ["url"]).orderBy("id").collect()] == [False, True, False, True]
    assert registry.flagged(rows, entries.limit(0), ["url"]).where("affiliated").count() == 0


def test_suffix_registry_with_more_slash_fragments_than_the_limit(spark, monkeypatch):
    monkeypatch.setattr(registry, "MOST_LITERALS", 2)
    fragments = ["a/1.pdf", "a/1.pdf", "a/1.pdf", "b/2.pdf", "x/y/3.pdf", "/4.pdf", "5/", "6.pdf"]
    urls = ["https://h/a/1.pdf", "b/2.pdf", "https://h/bb/2.pdf", "x/y/3.pdf", "https://h/x/y/3.pdf", "y/3.pdf", "https://h//4.pdf", "/4.pdf", "h/4.pdf", "h/5/", "h/15/", "h/6.pdf", None]
    rows = spark.createDataFrame(list(enumerate(urls)), "id int, url string").withColumn("mirror_url", F.lit(None).cast("string"))
    entries = spark.createDataFrame([(f,) for f in fragments], "entry string")
    want = [u is not None and any(u == f or u.endswith("/" + f) for f in fragments) for u in urls]
    assert [r["affiliated"] for r in registry.suffix_flagged(rows, entries, ["url", "mirror_url"]).orderBy("id").collect()] == want and sum(want) == 8


@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 3)), max_size=12))
@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_keep_is_idempotent(spark, rows):
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(rows)], "ordinal int, k string, v int")
    once = identity.keep(df, ["k"], ["ordinal"])
    assert sorted(map(tuple, identity.keep(once, ["k"], ["ordinal"]).collect())) == sorted(map(tuple, once.collect()))
    first = {}
    for i, (k, v) in enumerate(rows):
        first.setdefault(k, (i, k, v))
    assert sorted(map(tuple, once.collect())) == sorted(first.values())


def test_suffixes_beyond_99(spark):
    df = spark.createDataFrame([(i, "x") for i in range(1, 103)], "ordinal int, base string")
    got = [r["doc_id"] for r in identity.suffixed(df, "base", ["ordinal"]).orderBy("ordinal").collect()]
    assert got[:3] == ["x", "x-02", "x-03"] and got[-1] == "x-102"


def test_differences(spark):
    a, b = (spark.createDataFrame([(x, None) for x in v], "k string, l string") for v in (["a", "b", "b", None], ["b", "c"]))
    got = {(r["k"], r["side"]) for r in diff.keyed_difference(a, b, ["k", "l"]).collect()}
    assert got == {("a", "missing"), ("", "missing"), ("c", "extra")}
    x, y = (spark.createDataFrame(v, "name string, bytes long") for v in ([("n", 1), ("s", 2), ("u", 3)], [("s", 2), ("u", 4), ("o", 5)]))
    plan = diff.inventory_diff(x, y, ["name"])
    assert {r["name"]: r["action"] for r in plan.collect()} == {"n": "NEW", "s": "CURRENT", "u": "UPDATE", "o": "ORPHAN"}
    assert diff.plan_listing(plan, "name").count() == 4 and diff.plan_counts(plan).count() == 4


def test_title_overlaps(spark):
    rows = [("a long enough title", "x", "f.pdf", "A"), ("a long enough title", "x", "g.pdf", "B"), ("short", "x", "h.pdf", "A"), ("short", "x", "i.pdf", "B"), ("another long one here", "y", "z.pdf", "A"), ("another long one here", "y", "z.pdf", "B")]
    df = spark.createDataFrame(rows, "title string, author string, name string, origin string")
    assert [(r["title"], r["removable"]) for r in diff.title_overlaps(df, "title", "author", "name", "origin").collect()] == [("a long enough title", 1)]
    assert [(r["name"], r["removable"]) for r in diff.cross_origin(df, "name", "origin").collect()] == [("z.pdf", 1)]


def papers(spark):
    rows = [("Stars", "A B", "Astro", "J-1-1990-Issue-2", "1990", "", False, "", 5.0), ("Moon & Sun", "C", "Astro", "J-1-1990-Issue-10", "1990", "Cat", True, "", 1.0), ("Zero", "D", "nan", "J", "", "Cat", False, "m", None), ("old", "E", "", "J-1-Issue-1", "1899abc", "Other", False, "", 2.0)]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, title string, author string, subject string, journal string, year string, category string, affiliated boolean, mirror_url string, size double")


def ids(df):
    return [r["id"] for r in df.collect()]


def test_search(spark):
    p = papers(spark)
    go = lambda **k: ids(search.search(p, SearchRequest(**k), ["id"]))
    assert go() == [1, 0, 3, 2] and go(sort="oldest") == [2, 3, 0, 1] and go(sort="size") == [2, 1, 3, 0] and go(sort="title") == [1, 3, 0, 2]
    assert go(search="MOON c") == [1] and go(search="(", regex=True) == [] and go(search="^stars", regex=True) == [0]
    assert go(search="mirror") == [1, 2] and go(search="affiliated") == [1] and go(search="s", sort="relevance") == [0, 1, 3]
    assert go(categories=["Uncategorized"]) == [0] and go(subjects=["General"]) == [3, 2] and go(decades=["1890s", "Unknown"]) == [3, 2] and go(affiliated_only=True) == [1]
    assert search.counts(p, SearchRequest(limit=1)).first().asDict() == {"results": 4, "more": 3}
    facets = {(r["facet"], r["value"]) for r in search.facet_values(p).collect()}
    assert ("decade", "1890s") in facets and ("category", "Uncategorized") in facets and ("subject", "General") in facets and len(facets) == 7
    assert search.rendered(p, SearchRequest(search="sun")).where("id = 1").first()["title_html"] == "Moon &amp; <mark>Sun</mark>"


def test_links_and_targets(spark):
    rows = spark.createDataFrame([("pdf", "m", "r", "k/a b.pdf"), ("pdf", "", "https://h/x.pdf?q", ""), ("link", "m", "r", ""), ("pdf", "", "", "")], "t string, m string, r string, k string")
    c = F.col
    first = search.primary_link(c("t"), c("m"), search.archive_link(c("k"), c("r")), c("r"))
    assert [r[0] for r in rows.select(first).collect()][:3] == ["m", "/archive?file=assets%2Fmain%2Fx.pdf", "r"]
    got = rows.select(search.access_targets(c("t"), c("m"), c("m"), c("r"), F.lit("z")).alias("x")).first()["x"]
    assert [(t["kind"], t["href"]) for t in got] == [("read", "m"), ("source", "r"), ("archive", "z")]


def test_requests_and_recent(spark):
    r = SearchRequest.from_query("?search=a+b&category=X,%20Y,&affiliated=1&theme=dark&embed=1")
    assert (r.search, r.categories, r.affiliated_only, r.theme, r.embedded) == ("a b", ["X", "Y"], True, "dark", True)
    saved = spark.createDataFrame([('[{"query":"a","useRegex":true,"ts":1},{"x":1},{"query":"b"}]',), ("no",), (None,)], "saved string")
    got = [[(x["query"], x["use_regex"], x["ts"]) for x in r["recent"]] for r in readers.recent_searches(saved).collect()]
    assert got == [[("a", True, 1.0), ("b", False, 0.0)], [], []]
    h = spark.createDataFrame([("u", "Sun", False, 1), ("u", "sun", False, 2), ("u", "x", False, 3), ("u", "sun", True, 4)], "user string, query string, use_regex boolean, ts int")
    assert [(r["query"], r["use_regex"]) for r in search.remembered(h, ["user"]).orderBy("place").collect()] == [("sun", True), ("sun", False)]


def test_patches(spark):
    df = spark.createDataFrame([("A", "x_1", "p"), ("B", "y_2", "q"), (None, None, None)], "journal string, url string, author string")
    rules = [legacy.JournalRule("A", "x", "B"), legacy.JournalRule("B", "_1", "C")]
    out = legacy.patched(df, rules, [("y_", "New")], spark.createDataFrame([("y_2",)], "entry string"))
    assert {(r["journal"], r["author"], r["affiliated"]) for r in out.collect()} == {("C", "p", False), ("B", "New", True), (None, None, False)}
    assert legacy.patch_counts(df, rules, [("y_", "New")]).first().asDict() == {"journal_0": 1, "journal_1": 1, "author_0": 1}


def test_file_dedupe_and_migration(spark):
    df = spark.createDataFrame([(1, "https://o/a.pdf?x"), (2, "https://portal.example.org/a.pdf"), (3, ""), (4, ""), (5, "https://o/b.pdf")], "ordinal int, url string")
    assert sorted(r["ordinal"] for r in legacy.deduplicated_files(df, "portal.example.org").collect()) == [2, 3, 4, 5]
    old = spark.createDataFrame([("j", "p", "s", "c", "a", " https://h/u.pdf ", "1", "2", "", "TRUE"), ("j", "p", "s", "c", "a", "", "1", "2", "https://m/v.pdf", ""), ("j", "p", "s", "c", "a", None, "1", "2", None, None)], "journal string, paper string, subject string, category string, author string, url string, size_in_kb string, year string, mirror_url string, affiliated string")
    new = legacy.migrated(old)
    assert [r["object_key"] for r in new.collect()] == ["main/u.pdf", "other/v.pdf", ""]
    assert legacy.migration_counts(new).first().asDict() == {"rows": 3, "flagged": 1, "flagged_without_url": 0, "keyless": 1}


def test_names_and_triage(spark):
    files = spark.createDataFrame([(n, 3000) for n in ("annals_2001_on_stars.pdf", "annals_x.pdf", "BULL_a_b.pdf", "own-long-tale.pdf", "The_gazette.pdf", "time-2015.pdf", "$x.pdf", "index.html", "n.txt", "have.pdf", "used.pdf")], "name string, bytes long")
    index = spark.createDataFrame([("https://h/used.pdf", None)], "url string, mirror_url string")
    t = legacy.triage(files, spark.createDataFrame([("have.pdf",)], "name string"), index)
    assert {r["name"]: r["status"] for r in t.where("status <> 'new'").collect()} == {"$x.pdf": "dollar prefix", "index.html": "skip list", "n.txt": "no pdf", "have.pdf": "stored", "used.pdf": "referenced"}
    got = {r["object_key"]: (r["journal"], r["paper"], r["size_in_kb"]) for r in legacy.ingested(t).collect()}
    assert got["other/annals_2001_on_stars.pdf"] == ("Annals", "On Stars", "2") and got["other/annals_x.pdf"][1] == "annals_x" and got["other/BULL_a_b.pdf"] == ("Bulletin", "BULL a b", "2")
    assert got["other/own-long-tale.pdf"][1] == "Long Tale" and got["other/The_gazette.pdf"] == ("Gazette", "The Gazette", "2") and got["other/time-2015.pdf"] == ("Other", "Time 2015", "2")


def test_portal_metadata(spark):
    o = spark.createDataFrame([("Year 1999, Volume 34, Issue 2",), ("Year 2001, Volume 36, Issue 3&4",)], "o string")
    assert [r[0] for r in o.select(legacy.issue_id(F.col("o"))).collect()] == ["jrnl_1999_34_02", "jrnl_2001_36_03-4"]
    u = spark.createDataFrame([("https://h/writereaddata/Vol9_1.pdf",), ("https://h/(S(1))/writereaddata/x",), ("https://h/y.PDF",)], "u string")
    assert [r[0] for r in u.select(legacy.repaired_url(F.col("u"))).collect()] == ["https://h(S(session))/writereaddata/Vol09_1.pdf", "https://h/(S(1))/writereaddata/x.pdf", "https://h/y.PDF"]
    issues = spark.createDataFrame([("Year 1999, Volume 34",), ("Year 2000, Volume 35",)], "option string")
    assert legacy.target_issues(issues, [["1999", "34"]]).count() == 1 and legacy.target_issues(issues, [["1900"]]).count() == 2
    known = spark.createDataFrame([("a.pdf",)], "name string")
    assert [r["url"] for r in legacy.to_download(spark.createDataFrame([("h/A.pdf",), ("h/b.pdf",), ("h/b.pdf",)], "url string"), known).collect()] == ["h/b.pdf"]


def test_classification(spark):
    src = spark.createDataFrame([(1, "J", " Contents ", "u1"), (2, "J", "A study", "u2"), (3, "J", "A study", "u2"), (4, None, "Known", None), (5, "J", "Done", "u5")], "ordinal int, journal string, paper string, url string")
    done = spark.createDataFrame([("J", "Done ", "S", "C"), (None, "Known", "S", "C"), ("J", "A study", None, "C")], "journal string, paper string, subject string, category string")
    q = legacy.classification_queue(src, done)
    assert {(r["paper"], r["category"]) for r in q.collect()} == {("Contents", "Other"), ("A study", None)}
    assert [r["paper"] for r in legacy.classified_by(q, legacy.stub_classifier).collect()] == ["A study"]
    classes = spark.createDataFrame([("J", "Done", "old", "o", 1), ("J", "Done", "new", "n", 2), (None, "Known", "S", "C", 3)], "journal string, paper string, subject string, category string, ordinal int")
    assert {(r["ordinal"], r["subject"]) for r in legacy.merged_classes(classes, src).collect()} == {(1, None), (2, None), (3, None), (4, "S"), (5, "new")}


def test_import(spark):
    s = Settings()
    m = s.mirror_base
    table = spark.createDataFrame([(1, "Étude A", "u1", "1990.0", ""), (2, "Etude a", "u2", "", ""), (3, "Other", "u3", "1991", "have")], "ordinal int, paper string, url string, year string, mirror_url string")
    inc = spark.createDataFrame([(1, 1, "Etude A", "../assets/x.pdf", "1990"), (2, 1, "etude a", m + "y.pdf", "2005"), (3, 1, "Etude A", m + "z.pdf", "1990"), (4, 1, "Other", m + "o.pdf", "1991"), (5, 1, "No link", None, "1"), (1, 2, "New", m + "y.pdf", ""), (2, 2, "Newer", "https://else/n.pdf", "2001"), (3, 2, "Known", "u3", "")], "ordinal int, part int, title string, url string, year string")
    inc = inc.withColumn("journal", F.lit("J")).withColumn("author", F.lit("A")).withColumn("size", F.lit("9"))
    done, new = legacy.import_links(inc, table, s)
    assert {r["ordinal"]: r["mirror_url"] for r in done.collect()} == {1: m + "x.pdf", 2: m + "y.pdf", 3: "have"}
    assert {(r["part"], r["paper"], r["size_in_kb"]) for r in new.collect()} == {(1, "Etude A", "0"), (1, "Other", "0"), (2, "Newer", "9")}


def test_markdown_listings(spark, tmp_path):
    (tmp_path / "a.md").write_text("x\n| # | Journal | Paper | Author |\n|---|---|---|---|\n| 1 | J | [T **x**](u) | A |\n| 2 | K | plain | B |\n| short |\nend\n")
    a = readers.named_listing(readers.lines(spark, str(tmp_path / "a.md")))
    assert [(r["journal"], r["title"], r["author"]) for r in a.orderBy("ordinal").collect()] == [("J", "T **x**", "A"), ("K", "plain", "B")]
    (tmp_path / "b.md").write_text("| # | Year |\n|--|--|\n| 1 | 1990 |\n| 2 | 1991 |\n\n| not | this |\n")
    b = readers.marked_listing(readers.lines(spark, str(tmp_path / "b.md")), "| # | Year |")
    assert [r["cells"] for r in b.orderBy("ordinal").collect()] == [["1", "1990"], ["2", "1991"]]
    row = spark.createDataFrame([("[**T**](https://u)",), ("none",)], "c string").select(readers.linked(F.col("c")).alias("l")).collect()
    assert [(r["l"]["title"], r["l"]["url"]) for r in row] == [("T", "https://u"), ("none", None)]


def test_html_listing(spark, tmp_path):
    page = """<div class="col-xs-8"><table><tbody><tr><td>Journal of Record</td><td>12 1999</td></tr></tbody></table></div>
<div class="question col-xs-11"><a href="../f/a b.pdf">First</a></div><div>x</div><div>Auth One</div>
<div class="question col-xs-11"><a href="../f/c.pdf">Second</a></div><div>x</div><div>Auth Two</div>"""
    (tmp_path / "p.html").write_text(page)
    (tmp_path / "q.html").write_text(page)
    got = readers.html_listing(spark, str(tmp_path), "https://h.x/", "Journal of Record", "JRNL")
    assert sorted(map(tuple, got.collect())) == [("JRNL-12-1999", "First", "Auth One", "https://h.x//f/a%20b.pdf"), ("JRNL-12-1999", "Second", "Auth Two", "https://h.x//f/c.pdf")]


def test_ordinals_over_splits(spark, tmp_path):
    rng = random.Random(1)
    lines = [f"{i} " + "x" * rng.randint(0, 50) for i in range(1, 5001)]
    (tmp_path / "big.txt").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        got = readers.lines(spark, str(tmp_path / "big.txt")).select("ordinal", F.split("line", " ")[0].cast("long").alias("n"))
        assert got.where("ordinal <> n").count() == 0 and got.count() == 5000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_small_readers(spark, tmp_path):
    assert readers.mirrors(spark, str(tmp_path / "none.tsv")).count() == 0
    (tmp_path / "main").mkdir()
    (tmp_path / "main" / "X.PDF").write_bytes(b"1")
    (tmp_path / "main" / "y.pdf").write_bytes(b"1")
    assert {r["name"] for r in readers.known_names(spark, [str(tmp_path / "main"), str(tmp_path / "no")]).collect()} == {"x.pdf", "y.pdf"}
    assert {r["name"] for r in readers.inventory(spark, {"main": str(tmp_path / "main")}).collect()} == {"y.pdf"}
    assert readers.asset_root([None, "/nope", str(tmp_path)], ("main",)) == str(tmp_path) and readers.asset_root(["/nope"], ("main",)) == "/nope"
    objects = spark.createDataFrame([("a/x.pdf", 1), ("b/x.pdf", 2), ("c/", 0)], "name string, bytes long")
    assert [tuple(r) for r in readers.remote_listing(objects).collect()] == [("x.pdf", 2)]
    rows = spark.createDataFrame([("k", "a", "1"), ("k", "b", "2")], "journal string, subject string, category string")
    from corpusloom.sources import sinks

    path = sinks.tsv(rows, str(tmp_path / "e.tsv"), end="\n")
    assert [tuple(r) for r in readers.enrichment(spark, path, ["journal"]).collect()] == [("k", "b", "2")]
    assert readers.enrichment(spark, str(tmp_path / "no.tsv"), ["journal"]).count() == 0
    assert [r["line"] for r in sinks.markdown_rows(rows, ["subject", "category"], ["subject"]).collect()] == ["| a | 1 |", "| b | 2 |"]


def test_class_cache_and_report(spark, tmp_path):
    q = spark.createDataFrame([("J", "one", None), ("J", "two", None), ("J", "known", "S")], "journal string, paper string, subject string")
    folder, log = str(tmp_path / "cache"), tmp_path / "log"

    def classify(frames):
        for f in frames:
            with open(log, "a") as out:
                out.write("".join(f"{p}\n" for p in f.paper))
            yield f[["journal", "paper"]].assign(subject="X", category="Y", reasoning="z")

    assert legacy.classified_with_cache(q.where("paper = 'one'"), classify, folder).count() == 1
    assert {r["paper"] for r in legacy.classified_with_cache(q, classify, folder).collect()} == {"one", "two"}
    assert sorted(log.read_text().split()) == ["one", "two"]
    rows = spark.createDataFrame([("Journal of Record 1", "a|b", "s", None, "x y.pdf", "12.7", "me")], "journal string, paper string, subject string, category string, url string, size_in_kb string, author string")
    assert tuple(legacy.report_rows(rows, "Journal of Record", "JRNL").first()) == (1, "JRNL 1", "s", "", "[a-b](x%20y.pdf)", "me", "12")


def test_row_numbers_and_batches(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["a", "a", "a", "b", None]), x) for x in rng.sample(range(10_000), 400)] + [("a", None)]
    df = spark.createDataFrame(rows, "k string, v long").repartition(5)
    got = {(r["k"], r["v"]): (r["row_number"], r["batch"]) for r in identity.batched(identity.row_numbers(df, "v", ["k"], ranges=7), "v", 15, within=["k"]).collect()}
    for k in ("a", "b", None):
        own = sorted((v for x, v in rows if x == k), key=lambda v: (v is not None, v))
        assert [got[(k, v)] for v in own] == [(i + 1, i // 15) for i in range(len(own))]
    assert [r["row_number"] for r in identity.row_numbers(df, "v").orderBy(F.col("v").asc_nulls_first()).collect()] == list(range(1, 402))


def test_duplicates_and_seen_with_nulls(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "x"), (4, None), (5, "y")], "o int, k string")
    assert [r["duplicated"] for r in identity.duplicated(df, ["k"]).orderBy("o").collect()] == [True, True, True, True, False]
    assert [r["seen_before"] for r in identity.seen_before(df, ["k"], ["o"]).orderBy("o").collect()] == [False, False, True, True, False]


def test_many_fragments_scan_once(spark):
    fragments = [f"frag{i}x" for i in range(40)] + ["ag1", "é", "$$q"]
    entries = spark.createDataFrame([(f,) for f in fragments], "entry string")
    texts = ["a frag7x b", "ag", "frag12", "café", None, "", "q", "none"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "id int, t string")
    got = [r["affiliated"] for r in registry.flagged(df, entries, ["t"]).orderBy("id").collect()]
    assert got == [x is not None and any(f.lstrip("$") in x for f in fragments) for x in texts]
    left = {r["entry"] for r in registry.unmatched_entries(entries, df, "t").collect()}
    assert left == {f for f in fragments if not any(x and f.lstrip("$") in x for x in texts)}
