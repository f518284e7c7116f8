"""Bounds, hot keys and sidecars of the engine, and that every registered query has SQL."""

from __future__ import annotations

import json
import unicodedata

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.functions.python import fold_accents, folded_title
from corpusloom.operators import diff, identity, registry, sidecars
from corpusloom.operators.constraints import ConstraintError, assert_unique
from corpusloom.plans import audit, bindings
from corpusloom.plans.queries import ORACLES, QUERIES
from corpusloom.sources import places, sinks
from tests.conftest import DATA


def test_every_query_has_sql_and_reads_whole_tables():
    assert set(QUERIES) == set(ORACLES) and len(QUERIES) >= 116


def test_registries_beyond_their_bounds_are_refused(spark, monkeypatch):
    df = spark.createDataFrame([("a text",)], "t string")
    entries = spark.createDataFrame([(f"fragment {i}",) for i in range(30)], "entry string")
    for name, most in (("MOST_LITERALS", 29), ("MOST_BYTES", 100)):
        with monkeypatch.context() as m:
            m.setattr(registry, name, most)
            for go in (lambda: registry.flagged(df, entries, ["t"]), lambda: registry.unmatched_entries(entries, df, "t")):
                with pytest.raises(ValueError, match="match it in parts"):
                    go()


def test_long_fragments_are_verified_whole():
    shared = "the same long beginning of many fragments "
    own = registry.Fragments([shared + x for x in ("one", "two", "one more")] + ["x", "é" * 30])
    assert list(own.within("nothing")) == [] and list(own.within(shared + "three")) == []
    assert sorted(own.within("ax " + shared + "one more " + "é" * 31)) == sorted(["x", shared + "one", shared + "one more", "é" * 30, "é" * 30])


def test_audit_json_holds_every_issue(spark, tmp_path):
    ctx = bindings.context(spark, DATA)
    results, severities = audit.run(ctx, ["mirror_registry_mismatches", "doc_id_collisions"])
    whole = json.loads(open(sinks.audit_json(results, severities, str(tmp_path / "a.json")), encoding="utf-8").read())
    by = {r["name"]: r for r in whole["results"]}
    assert all(len(by[r["name"]]["issues"]) == r["issue_count"] > 20 == len(r["issues"]) for r in results) and whole["severity_counts"] == severities
    assert whole["selected_checks"] == ["mirror_registry_mismatches", "doc_id_collisions"] and set(by["doc_id_collisions"]["issues"][0]) == {"severity", "message", "details"}
    report = open(sinks.audit_markdown(results, severities, str(tmp_path / "a.md"))).read()
    assert report.count("- [info]") == 20


def test_a_store_that_breaks_its_keys_leaves_the_old_one(spark, tmp_path):
    where = str(tmp_path / "store")
    good = spark.createDataFrame([("a",), ("b",)], "k string")
    check = lambda t: assert_unique(t["t"], ["k"], "t")
    sinks.store({"t": good}, where, check=check)
    with pytest.raises(ConstraintError):
        sinks.store({"t": good.union(good)}, where, check=check)
    assert sinks.open_store(spark, where, ["t"])["t"].count() == 2 and not (tmp_path / "store.staging").exists()


def test_suffixes_of_a_hot_base_go_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(identity, "BLOCK", 50)
    rows = [(i, "hot" if i % 3 else f"b{i % 7}") for i in range(1, 901)] + [(1000, None), (1001, None)]
    got = {r["o"]: r["doc_id"] for r in identity.suffixed(spark.createDataFrame(rows, "o long, base string").repartition(5), "base", ["o"]).collect()}
    seen: dict = {}
    for o, base in rows:
        seen[base] = seen.get(base, 0) + 1
        assert got[o] == (base if seen[base] == 1 or base is None else f"{base}-{seen[base]:02d}") or base is None
    plan = identity.suffixed(spark.createDataFrame(rows, "o long, base string"), "base", ["o"])
    assert plan.columns == ["o", "base", "doc_id"] and plan.count() == 902


def test_shared_members_of_a_hot_key(spark):
    rows = [("hot", i % 300) for i in range(900)] + [(f"k{i}", i) for i in range(50)] + [("two", 1), ("two", 2), ("", 1), ("", 2), (None, 1), (None, 2)]
    df = spark.createDataFrame(rows, "k string, m int")
    got = diff.shared_members(df, "k", "m").collect()
    assert {(r["k"], r["n"]) for r in got} == {("hot", 300), ("two", 2)} and len(got) == 302
    assert {r["k"]: r["members"] for r in diff.shared_keys(df, "k", "m").collect()} == {"hot": list(range(300)), "two": [1, 2]}


def test_moved_within_one_table(spark):
    rows = [(1, 0, "A", "x"), (2, 0, "A", "x"), (3, 0, "B", "y"), (4, 0, "C", "z"), (5, 1, "D", "x"), (6, 1, "B", "y"), (7, 1, "C", "x")]
    df = spark.createDataFrame(rows, "o int, listing int, g string, t string")
    got = sorted((r["o"], r["moved_to"], r["status"]) for r in diff.moved_within(df, "listing", "g", "t", "o").collect())
    assert got == [(1, "D", "moved"), (2, "D", "moved"), (4, None, "missing")]
    listing = diff.gap_listing(diff.moved_within(df, "listing", "g", "t", "o"), "g", "t").collect()
    assert [r["status"] for r in listing] == ["moved", "moved", "missing"]


def test_titles_fold_as_the_unicode_tables(spark):
    marks = [chr(c) for c in range(32, 0x2000)] + [chr(c) for c in range(0x2000, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    texts = ["a" + "b".join(marks[i : i + 40]) + "z" for i in range(0, len(marks), 40)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = lambda t: "".join(ch for ch in unicodedata.normalize("NFD", t) if unicodedata.category(ch) != "Mn")
    want = ["".join(ch for ch in plain(t).lower() if ch.isascii() and ch.isalnum()) for t in texts]
    assert [r[0] for r in df.select(folded_title("t")).collect()] == want
    assert [r[0] for r in df.select(fold_accents("t")).collect()] == [plain(t) for t in texts]


def test_small_functions(spark):
    df = spark.createDataFrame([("main/a/b",), ("none",), ("/x",)], "p string")
    assert [tuple(r[0]) for r in df.select(X.partition(F.col("p"))).collect()] == [("main", "a/b"), ("none", ""), ("", "x")]
    assert audit.check_names() == sorted(audit.CHECKS)
    path = sinks.written(spark, places.scratch(spark, "w") + "/f.txt", (f"é{i}\n" for i in range(3)))
    assert [r[0] for r in spark.read.text(path).orderBy("value").collect()] == ["é0", "é1", "é2"]


def test_chunks_cover_a_text(spark):
    texts = ["", None, "a" * 99, "b" * 100, "c" * 101, "é\n" * 500, "x" * 190, "x" * 191]
    rows = sidecars.chunk_texts(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), 100, 10).orderBy("doc_id", "chunk_index").collect()
    by: dict = {}
    for r in rows:
        assert texts[r["doc_id"]][r["char_start"] : r["char_end"]] == r["chunk_text"] and len(r["chunk_text"]) <= 100
        by.setdefault(r["doc_id"], []).append(r)
    assert {k: len(v) for k, v in by.items()} == {2: 1, 3: 1, 4: 2, 5: 11, 6: 2, 7: 3}
    assert all(v[-1]["char_end"] == len(texts[k]) for k, v in by.items())
    with pytest.raises(ValueError):
        sidecars.chunk_texts(spark.range(1), 100, 60)


def test_terms_and_search(spark):
    rows = sidecars.term_index(spark.createDataFrame([(1, "Été ete, x"), (2, "x x"), (3, None), (4, "!")], "chunk_id int, chunk_text string"))
    assert {(r["term"], r["chunk_id"], r["tf"]) for r in rows.collect()} == {("ete", 1, 2), ("x", 1, 1), ("x", 2, 2)}
    assert [tuple(r) for r in sidecars.term_search(rows, ["X", "ete", "x"]).collect()] == [(1, 3)]
    assert {tuple(r) for r in sidecars.term_statistics(rows).collect()} == {("ete", 1, 2), ("x", 2, 3)}


def test_overrides(spark):
    docs = spark.createDataFrame([("d1", "t", 1, True, "portal"), ("d2", None, 2, False, "files")], "doc_id string, title string, n int, flag boolean, source_root string")
    shape = "override_id string, doc_id string, target_table string, target_field string, override_value_json string, applies_to_source_type string, created_at string"
    made = [("1", "d1", "documents", "title", '"new \\"q\\""', None, "2"), ("2", "d1", "documents", "title", '"old"', None, "1"), ("3", "d1", "documents", "n", "41", "files", "3"), ("4", "d2", "documents", "n", "42", "files", "1"), ("5", "d2", "documents", "flag", "true", None, "1"), ("6", "d1", "documents", "flag", "null", None, "1"), ("7", "d1", "assets", "nope", "1", None, "1"), ("8", "gone", "documents", "n", "1", None, "1")]
    got = {r["doc_id"]: tuple(r)[1:] for r in sidecars.overridden(docs, spark.createDataFrame(made, shape), "documents").collect()}
    assert got == {"d1": ('new "q"', 1, None, "portal"), "d2": (None, 42, True, "files")}
    for field in ("nope", "doc_id"):
        with pytest.raises(ValueError, match=field):
            sidecars.overridden(docs, spark.createDataFrame([("1", "d1", "documents", field, "1", None, "1")], shape), "documents")


def test_stale_and_rebuilt(spark):
    a, b = (spark.createDataFrame(v, "k int, x string") for v in ([(1, "a"), (2, "b"), (3, None)], [(1, "a"), (2, "B"), (4, "n")]))
    changes = sidecars.stale(sidecars.row_versions(a, "k"), sidecars.row_versions(b, "k"), "k")
    assert {r["k"]: r["state"] for r in changes.collect()} == {2: "changed", 3: "removed", 4: "added"}
    assert {tuple(r) for r in sidecars.rebuilt(a, b, changes, "k").collect()} == {(1, "a"), (2, "B"), (4, "n")}
