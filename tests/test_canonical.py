"""Canonical build, audit, projections and sinks over small synthetic roots."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.constraints import ConstraintError
from corpusloom.plans import audit, canonical, projections
from corpusloom.schemas import INDEX_COLUMNS
from corpusloom.settings import Settings
from corpusloom.sources import readers, sinks

S = Settings()
PORTAL = """journal\tpaper\turl\tsize_in_kb\tauthor
JRNL-1-1966-Issue-1\tA "quoted" title\thttps://h.x/a/Vol01.pdf\t12\tB C
JRNL-1-1966-Issue-1\t"with ""doubled"" quotes"\thttps://h.x/b/Vol01.pdf\t1.5d\t

JRNL-2-1967-Issue-1\tThird\thttps://h.x/c/Vol01.pdf?x=1\t
JRNL\tNotes\t\t7\t
Odd\tNotes on x\thttps://h.x/only link\t 3 \tD
"""
FILES = "journal\tpaper\turl\tsize_in_kb\tyear\tauthor\nOther\tCurated\thttps://o.x/p%20q.pdf\t\t2025.0\tE\nOther\tSame\thttps://o.x/gone.pdf\t4\tunknown\tE\n"
LINKS = "journal\tpaper\turl\tyear\tauthor\nMag A\tA link\thttps://magazine.example.com/ideas/why-not\t2001\tF\nMag A\tNo url\t\t\tF\n"
MIRRORS = "source_url\tmirror_url\nhttps://h.x/a/Vol01.pdf\thttps://m.x/old.pdf\nhttps://h.x/zzz.pdf\thttps://m.x/zzz.pdf\nhttps://o.x/p%20q.pdf\thttps://m.x/pq\n"
REGISTRY = "# comment\n\n$Vol01.pdf\nnobody\n$\n"


@pytest.fixture(scope="module")
def roots(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("roots")
    paths = {}
    for name, text in (("portal", PORTAL), ("curated_files", FILES), ("curated_links", LINKS), ("mirrors", MIRRORS), ("registry", REGISTRY)):
        (d / f"{name}.tsv").write_text(text, encoding="utf-8")
        paths[name] = str(d / f"{name}.tsv")
    for bucket, names in (("main", ["Vol01.pdf", "lone.pdf"]), ("other", ["p%20q.pdf", "p q.pdf", "Vol01.pdf"])):
        (d / bucket).mkdir()
        for n in names:
            (d / bucket / n).write_bytes(b"x" * 2048)
    inventory = readers.inventory(spark, {"main": str(d / "main"), "other": str(d / "other"), "none": str(d / "none")})
    return canonical.read_roots(spark, paths, inventory)


@pytest.fixture(scope="module")
def tables(roots):
    return {k: v.cache() for k, v in canonical.build(roots, S, F.lit("2024-01-01T00:00:00Z")).items()}


def test_scan_details(roots):
    rows = [r.asDict() for r in roots.portal.orderBy("ordinal").collect()]
    assert [r["ordinal"] for r in rows] == [1, 2, 3, 4, 5]
    assert rows[0]["paper"] == 'A "quoted" title' and rows[1]["paper"] == 'with "doubled" quotes' and rows[2]["author"] is None
    assert [r["entry"] for r in roots.registry.orderBy("ordinal").collect()] == ["$Vol01.pdf", "nobody", "$"]
    assert len(roots.versions["portal"]) == 8


def test_documents(tables):
    docs = {r["doc_id"]: r.asDict() for r in tables["documents"].collect()}
    assert set(docs) == {"Vol01", "Vol01-02", "Vol01-03", "portal-row-0004-notes", "only link", "p%20q", "gone", "mag-a-why-not", "mag-a-no-url"}
    assert docs["Vol01"]["year"] == "1966" and docs["Vol01"]["affiliated"] and docs["Vol01-03"]["entry_type"] == "link"
    assert not docs["p%20q"]["affiliated"] and docs["p%20q"]["year"] == "2025.0" and docs["mag-a-no-url"]["entry_type"] == "link"


def test_assets_and_sources(tables):
    assets = {r["asset_id"]: r.asDict() for r in tables["asset_refs"].collect()}
    assert assets["Vol01:primary"]["local_rel_path"] == "main/Vol01.pdf" and assets["Vol01:mirror"]["remote_url"] == "https://m.x/old.pdf"
    assert assets["p%20q:primary"]["local_rel_path"] == "other/p%20q.pdf" and assets["gone:primary"]["availability_status"] == "remote_only"
    assert assets["mag-a-why-not:primary"]["asset_role"] == "external_link" and len(assets) == 11
    raw = {r["source_row_id"]: json.loads(r["raw_metadata_json"]) for r in tables["document_sources"].collect()}
    assert list(raw["portal:00003"]) == ["journal", "paper", "url", "size_in_kb", "author"] and raw["portal:00003"]["author"] is None


def test_clash_between_sources_aborts(spark, roots):
    from dataclasses import replace

    clash = spark.createDataFrame([("J", "P", "https://z/Vol01.pdf", "1", "2000", "A", 1)], "journal string, paper string, url string, size_in_kb string, year string, author string, ordinal long")
    with pytest.raises(ConstraintError, match="doc_id"):
        canonical.build(replace(roots, curated_files=clash), S)


def test_index_and_round_trip(spark, tables, tmp_path):
    key = ["journal", "paper", "url", "entry_type"]
    lookup = spark.createDataFrame([("JRNL-1-1966-Issue-1", 'A "quoted" title', "https://h.x/a/Vol01.pdf", "pdf", " ", ""), ("Mag A", "A link", "https://magazine.example.com/ideas/why-not", "link", "S", "")], ", ".join(f"{k} string" for k in [*key, "subject", "category"]))
    fallback = spark.createDataFrame([("JRNL-1-1966-Issue-1", 'A "quoted" title', "https://h.x/a/Vol01.pdf", "pdf", "FS", "FC")], lookup.schema)
    index = projections.index(tables["documents"], tables["document_sources"], tables["asset_refs"], lookup, fallback, S)
    rows = {r["paper"]: r.asDict() for r in index.collect()}
    assert rows['A "quoted" title']["subject"] == "FS" and rows["A link"]["subject"] == "S" and rows["A link"]["category"] == ""
    assert rows["A link"]["size_in_kb"] == "0" and rows["A link"]["source"] == "magazine" and rows["Third"]["size_in_kb"] == "0" and rows["Notes on x"]["size_in_kb"] == " 3 "
    assert rows['A "quoted" title']["mirror_url"] == "https://m.x/old.pdf" and rows["Curated"]["source"] == "portal" and rows["Curated"]["year"] == "2025.0"
    path = sinks.index_tsv(index, str(tmp_path / "index.tsv"))
    text = open(path, newline="", encoding="utf-8").read()
    assert text.split("\r\n")[0].split("\t") == INDEX_COLUMNS and text.count("\r\n") == 10
    again = readers.tsv(spark, path)
    report = projections.compare(again, again.where("paper <> 'A link'"))
    assert report["n_extra"] == 1 and report["n_missing"] == 0 and report["same_header"] and report["rows"] == (9, 8)
    assert "A link" in open(sinks.validation_markdown(report, str(tmp_path / "v.md"))).read()


def test_web_and_featured(spark, roots, tables, tmp_path):
    index = projections.index(tables["documents"], tables["document_sources"], tables["asset_refs"], spark.createDataFrame([], "journal string, paper string, url string, entry_type string, subject string, category string"), None, S)
    web = projections.web_records(index, roots.inventory, S)
    rows = {r["title"]: r.asDict() for r in web.collect()}
    assert rows["Curated"]["year"] == "2025" and rows["Curated"]["size"] == 2.0 and rows["Curated"]["local_path"] == "assets/pdfs/other/p%20q.pdf"
    assert rows['with "doubled" quotes']["size"] == 2.0 and rows["A link"]["local_path"] is None
    featured = projections.featured(web, S)
    out = projections.payload(featured).first()
    assert out["row_count"] == 3 == len(out["rows"]) and [r["year"] for r in out["rows"]] == ["1967", "1966", "1966"] and out["rows"][0]["category"] == "General"
    path = sinks.script([r.asDict() for r in out["rows"]], str(tmp_path / "f.js"), "FEATURED", "featured:ready")
    assert open(path).read().startswith("window.FEATURED = [")


def test_audit(roots, tables, tmp_path):
    ctx = audit.AuditContext(roots, tables["documents"], tables["document_sources"], tables["asset_refs"], S)
    results, severities = audit.run(ctx)
    by = {r["name"]: r for r in results}
    s = by["root_input_validation"]["summary"]
    assert s["portal_missing_required"] == 2 and s["portal_non_numeric_size"] == 1 and s["portal_expected_authorless"] == 1 and s["portal_unexpected_blank_author"] == 2
    assert s["portal_unmatched_local_filename"] == 1 and s["portal_non_pdf_url"] == 1
    assert s["curated_files_non_numeric_year"] == 1 and s["curated_files_blank_size_in_kb"] == 1 and s["curated_files_unmatched_local_filename"] == 1
    assert s["curated_links_missing_required"] == 1 and s["mirror_non_pdf_url"] == 1 and s["mirror_source_unmatched"] == 1 and s["mirror_same_source_and_target"] == 0
    orphans = {i["details"]["local_rel_path"] for i in by["orphan_files"]["issues"]}
    assert orphans == {"main/lone.pdf", "other/Vol01.pdf"}  # "p q.pdf" is known by its encoded form
    assert {i["details"]["doc_id"] for i in by["doc_id_collisions"]["issues"]} == {"Vol01-02", "Vol01-03"}
    assert {i["details"]["registry_entry"] for i in by["registry_mismatches"]["issues"] if "registry_entry" in i["details"]} >= {"nobody"}
    assert by["duplicate_asset_mappings"]["issue_count"] == 1 and by["missing_local_files"]["issue_count"] >= 1
    assert by["mirror_registry_mismatches"]["issue_count"] == 2 and by["root_inventory"]["issue_count"] == 0
    assert by["core_field_quality"]["summary"]["missing_author_display"] == 2 and sum(severities.values()) == sum(r["issue_count"] for r in results)
    assert "## orphan_files" in open(sinks.audit_markdown(results, severities, str(tmp_path / "a.md"))).read()
    assert json.loads(open(sinks.audit_json(results, severities, str(tmp_path / "a.json"))).read())["severity_counts"] == severities


def test_store(spark, tables, tmp_path):
    where = str(tmp_path / "store")
    sinks.store({"documents": tables["documents"]}, where)
    sinks.store({"documents": tables["documents"].limit(3)}, where)
    assert sinks.open_store(spark, where, ["documents"])["documents"].count() == 3
    assert sinks.store({"documents": tables["documents"]}, where, write=False) == {"documents": f"{where}/documents"}
