"""Data-quality checks over roots, canonical tables and file inventories: each is a frame of issues and one of counts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from corpusloom.functions.text import clean, is_float, is_pdf_path, percent_encode, url_basename
from corpusloom.operators.identity import samples
from corpusloom.operators.registry import flagged, unmatched_entries
from corpusloom.plans.canonical import Roots
from corpusloom.schemas import ROOT_HEADERS
from corpusloom.settings import Settings

ISSUE = "severity string, message string, details map<string,string>"


@dataclass(frozen=True)
class AuditContext:
    """What the checks read; frames stay lazy (D12)."""

    roots: Roots
    documents: DataFrame
    sources: DataFrame
    assets: DataFrame
    settings: Settings


def procedural(title: Column, settings: Settings) -> Column:
    """Has such an entry no author by its nature (FI7)?"""
    return title.rlike("(?i)(?:" + "|".join(settings.procedural_titles) + ")")


def issue(df: DataFrame, severity: str, message: str, **details: Column) -> DataFrame:
    pairs = [x for k, v in details.items() for x in (F.lit(k), v.cast("string"))]
    return df.select(F.lit(severity).alias("severity"), F.lit(message).alias("message"), F.create_map(*pairs).alias("details"))


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def missing(columns: list[str]) -> Column:
    """Names of the blank ones, in order (FI5)."""
    return F.array_compact(F.array(*[F.when(clean(c) == "", F.lit(c)) for c in columns]))


def _rows(df: DataFrame) -> DataFrame:
    return df.select("ordinal", *[clean(c).alias(c) for c in df.columns if c != "ordinal"])


def _absent(rows: DataFrame, inventory: DataFrame, bucket: str) -> DataFrame:
    """Rows whose file name isn't in a bucket (FI8, JN7)."""
    named = rows.where("url <> ''").withColumn("filename", url_basename("url")).where("filename <> ''")
    return named.join(inventory.where(F.col("bucket") == bucket).select(F.col("name").alias("filename")).distinct(), "filename", "left_anti")


def root_inventory(ctx: AuditContext) -> tuple[DataFrame, DataFrame]:
    """Headers in their order, and row counts (CK1)."""
    r, spark = ctx.roots, ctx.documents.sparkSession
    tables = {"portal": r.portal, "curated_files": r.curated_files, "curated_links": r.curated_links, "mirrors": r.mirrors}
    bad = [("error", "Root input header does not match expected shape", {"root_input": n, "expected": ",".join(ROOT_HEADERS[n]), "actual": ",".join(got)}) for n, t in tables.items() if (got := [c for c in t.columns if c != "ordinal"]) != ROOT_HEADERS[n]]
    counts = [t.agg(F.lit(f"{n}_rows").alias("key"), F.count("*").alias("value")) for n, t in (tables | {"registry": r.registry}).items()]
    files = [r.inventory.where(F.col("bucket") == b).agg(F.lit(f"files_{b}").alias("key"), F.count("*").alias("value")) for b in ctx.settings.buckets]
    return spark.createDataFrame(bad, ISSUE), union(counts + files)


def root_input_validation(ctx: AuditContext) -> tuple[DataFrame, DataFrame]:
    """All rules over the four root tables and the registry (CK2-CK6); counters are sums in one scan a table (AG5)."""
    r, s = ctx.roots, ctx.settings
    c = F.col
    parts, sums = [], []
    again = r.registry.groupBy("entry").count().where("count > 1")  # AG7
    parts.append(issue(again, "warning", "Registry has duplicate entry", registry_entry=c("entry")))
    sums.append(r.registry.agg(F.count_if(clean("entry") == "").alias("registry_blank_entries")))
    sums.append(again.agg(F.count("*").alias("registry_duplicate_entries")))

    p = _rows(r.portal)
    rules = {
        "missing_required": (F.size(missing(["journal", "paper", "url", "size_in_kb"])) > 0, "error", "Portal row is missing required fields", {"missing_fields": F.array_join(missing(["journal", "paper", "url", "size_in_kb"]), ","), "paper": c("paper")}),
        "non_pdf_url": ((c("url") != "") & ~is_pdf_path("url"), "error", "Portal row URL does not look like a PDF", {"url": c("url")}),
        "non_numeric_size": ((c("size_in_kb") != "") & ~is_float("size_in_kb"), "warning", "Portal row size_in_kb is not numeric", {"size_in_kb": c("size_in_kb"), "paper": c("paper")}),
        None: ((c("journal") != "") & ~c("journal").rlike(s.journal_pattern), "warning", "Portal row journal does not match the expected pattern", {"journal": c("journal"), "paper": c("paper")}),
        "unexpected_blank_author": ((c("author") == "") & ~procedural(c("paper"), s), "info", "Portal row has blank author outside the expected procedural patterns", {"paper": c("paper"), "journal": c("journal")}),
    }
    for name, (test, severity, message, details) in rules.items():
        parts.append(issue(p.where(test), severity, message, row_number=c("ordinal"), **details))
    absent = _absent(p, r.inventory, s.buckets[0])
    parts.append(issue(absent, "error", "Portal row URL basename is missing from the main asset root", row_number=c("ordinal"), filename=c("filename"), url=c("url")))
    sums.append(p.agg(*[F.count_if(t[0]).alias(f"portal_{n}") for n, t in rules.items() if n], F.count_if((c("author") == "") & procedural(c("paper"), s)).alias("portal_expected_authorless")))
    sums.append(absent.agg(F.count("*").alias("portal_unmatched_local_filename")))

    for name, label, table, last in (("curated_files", "Curated file", _rows(r.curated_files), True), ("curated_links", "Curated link", _rows(r.curated_links), False)):
        need = missing(["journal", "paper", "url", "year"])
        year = (c("year") != "") & ~is_float("year")
        parts.append(issue(table.where(F.size(need) > 0), "error", f"{label} row is missing required fields", row_number=c("ordinal"), missing_fields=F.array_join(need, ","), paper=c("paper")))
        parts.append(issue(table.where(year), "warning", f"{label} year is not numeric", row_number=c("ordinal"), year=c("year"), paper=c("paper")))
        counted = [F.count_if(F.size(need) > 0).alias(f"{name}_missing_required"), F.count_if(year).alias(f"{name}_non_numeric_year")]
        if last:
            no_pdf = (c("url") != "") & ~is_pdf_path("url")
            parts.append(issue(table.where(no_pdf), "error", f"{label} URL does not look like a PDF", row_number=c("ordinal"), url=c("url")))
            absent = _absent(table, r.inventory, s.buckets[1])
            parts.append(issue(absent, "error", f"{label} URL basename is missing from the other asset root", row_number=c("ordinal"), filename=c("filename"), url=c("url")))
            counted += [F.count_if(c("size_in_kb") == "").alias(f"{name}_blank_size_in_kb"), F.count_if(no_pdf).alias(f"{name}_non_pdf_url")]
            sums.append(absent.agg(F.count("*").alias(f"{name}_unmatched_local_filename")))
        sums.append(table.agg(*counted))

    m = _rows(r.mirrors)
    both = (c("source_url") != "") & (c("mirror_url") != "")
    urls = r.portal.select(clean("url").alias("source_url")).union(r.curated_files.select(clean("url"))).where("source_url <> ''").distinct()  # ST5
    alone = m.where("source_url <> ''").join(urls, "source_url", "left_anti")
    again = m.withColumn("_n", F.row_number().over(W.partitionBy("source_url", "mirror_url").orderBy("ordinal"))).where(both & (F.col("_n") > 1))  # WN5
    pair = {"row_number": c("ordinal"), "source_url": c("source_url"), "mirror_url": c("mirror_url")}
    parts += [
        issue(m.where(~both), "error", "Mirror row is missing source_url or mirror_url", **pair),
        issue(m.where((c("source_url") != "") & ~is_pdf_path("source_url")), "warning", "Mirror source_url does not look like a PDF", row_number=c("ordinal"), source_url=c("source_url")),
        issue(m.where((c("mirror_url") != "") & ~is_pdf_path("mirror_url")), "warning", "Mirror mirror_url does not look like a PDF", row_number=c("ordinal"), mirror_url=c("mirror_url")),
        issue(m.where(both & (c("source_url") == c("mirror_url"))), "error", "Mirror row uses the same URL for source and mirror", row_number=c("ordinal"), source_url=c("source_url")),
        issue(alone, "warning", "Mirror source_url does not match any PDF-backed root input URL", **pair),
        issue(again, "warning", "Mirror registry contains duplicate source/mirror pair", **pair),
    ]
    one = lambda k: ((c(k) != "") & ~is_pdf_path(k)).cast("int")
    sums.append(m.agg(F.count_if(~both).alias("mirror_missing_required"), F.coalesce(F.sum(one("source_url") + one("mirror_url")), F.lit(0)).alias("mirror_non_pdf_url"), F.count_if(both & (c("source_url") == c("mirror_url"))).alias("mirror_same_source_and_target")))
    sums.append(alone.agg(F.count("*").alias("mirror_source_unmatched")))
    return union(parts), union([melted(x) for x in sums])


def melted(counts: DataFrame) -> DataFrame:
    return counts.select(F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("bigint").alias("value")) for k in counts.columns])).alias("p")).select("p.key", "p.value")


def canonical_inventory(ctx: AuditContext) -> tuple[DataFrame, DataFrame]:
    """Counts of the canonical tables, by source and by type (CK7, AG1, AG2)."""
    sizes = [t.agg(F.lit(n).alias("key"), F.count("*").alias("value")) for n, t in (("documents", ctx.documents), ("document_sources", ctx.sources), ("asset_refs", ctx.assets))]
    by = [ctx.documents.groupBy(F.concat(F.lit(f"documents_by_{n}."), c).alias("key")).agg(F.count("*").alias("value")) for n, c in (("source", "source_root"), ("entry_type", "entry_type"))]
    return no_issues(ctx), union(sizes + by)


def no_issues(ctx: AuditContext) -> DataFrame:
    return ctx.documents.sparkSession.createDataFrame([], ISSUE)


def core_field_quality(ctx: AuditContext) -> tuple[DataFrame, DataFrame]:
    """Missing core fields, up to 20 of each kind (CK8, WN9)."""
    d, c = ctx.documents, F.col
    authorless = clean("author_display") == ""
    expected = (c("source_root") == "portal") & procedural(clean("title"), ctx.settings)
    kinds = {"title": ("error", clean("title") == ""), "author_display": ("warning", authorless & ~expected), "journal_label": ("warning", clean("journal_label") == ""), "entry_type": ("error", clean("entry_type") == "")}
    parts = [issue(samples(d.where(test).withColumn("_k", F.lit(k)), ["_k"], ["source_root", "doc_id"]), severity, f"Missing core field `{k}`", doc_id=c("doc_id"), source_root=c("source_root")) for k, (severity, test) in kinds.items()]
    sums = d.agg(*[F.count_if(t).alias(f"missing_{k}") for k, (_, t) in kinds.items()], F.count_if(authorless & expected).alias("expected_authorless"), F.count_if(clean("year") == "").alias("missing_year"), F.count_if((clean("year") == "") & F.startswith("journal_label", F.lit(ctx.settings.journal_code + "-"))).alias("year_derivable"))
    return union(parts), melted(sums)


def counts_by(df: DataFrame, by: list[str], **flags: Column) -> DataFrame:
    """Rows of each group, and those of them for which a flag holds (AG2, AG3)."""
    return df.groupBy(*by).agg(F.count("*").alias("n"), *[F.count_if(F.coalesce(x, F.lit(False))).alias(k) for k, x in flags.items()])


def deferred_field_status(ctx: AuditContext) -> tuple[DataFrame, DataFrame]:
    """Documents and flagged documents by source (CK9, AG3)."""
    by = counts_by(ctx.documents, ["source_root"], f=F.col("affiliated"))
    return no_issues(ctx), by.select(F.explode(F.array(F.struct(F.concat(F.lit("documents."), "source_root").alias("key"), F.col("n").alias("value")), F.struct(F.concat(F.lit("affiliated."), "source_root").alias("key"), F.col("f").alias("value")))).alias("p")).select("p.key", "p.value")


def counted(issues: DataFrame) -> tuple[DataFrame, DataFrame]:
    return issues, issues.agg(F.lit("issue_count").alias("key"), F.count("*").alias("value"))


def missing_local_files(ctx: AuditContext) -> tuple[DataFrame, DataFrame]:
    """File assets without a path, and paths without a file (CK10, JN8)."""
    files = ctx.assets.where("asset_role <> 'external_link'")
    none = files.where("coalesce(local_rel_path, '') = ''")
    have = ctx.roots.inventory.select(F.concat("bucket", F.lit("/"), "name").alias("local_rel_path")).distinct()
    gone = files.where("coalesce(local_rel_path, '') <> ''").join(have, "local_rel_path", "left_anti")
    c = F.col
    return counted(issue(none, "warning", "PDF asset has no local_rel_path", doc_id=c("doc_id"), remote_url=c("remote_url")).unionByName(issue(gone, "error", "Mapped PDF file is missing from shared asset root", doc_id=c("doc_id"), local_rel_path=c("local_rel_path"), remote_url=c("remote_url"))))


def orphan_files(ctx: AuditContext) -> tuple[DataFrame, DataFrame]:
    """Files that no asset maps, neither by name nor by its percent-encoded form (CK11, JN9, FN8)."""
    mapped = ctx.assets.where("coalesce(local_rel_path, '') <> ''").select(F.col("local_rel_path").alias("path")).distinct()
    files = ctx.roots.inventory.withColumn("path", F.concat("bucket", F.lit("/"), "name")).withColumn("alias", F.concat("bucket", F.lit("/"), percent_encode("name", "'()&,-._~")))
    alone = files.join(mapped, "path", "left_anti").join(mapped.withColumnRenamed("path", "alias"), "alias", "left_anti")
    return counted(issue(alone, "warning", "Shared PDF has no canonical row", local_rel_path=F.col("path")))


def duplicate_asset_mappings(ctx: AuditContext) -> tuple[DataFrame, DataFrame]:
    """Paths and URLs of several documents (CK12, AG6)."""
    from corpusloom.operators.diff import shared_keys

    parts = [issue(shared_keys(ctx.assets, k, "doc_id"), "warning", f"{label} is assigned to multiple documents", **{k: F.col(k), "doc_ids": F.array_join("members", ",")}) for k, label in (("local_rel_path", "Local asset path"), ("remote_url", "Remote URL"))]
    return counted(union(parts))


def doc_id_collisions(ctx: AuditContext) -> tuple[DataFrame, DataFrame]:
    """Ids that look as if they had a collision suffix (CK13, FI10)."""
    some = ctx.documents.where(F.col("doc_id").rlike(r"-(0[2-9]|[1-9][0-9])$"))
    return counted(issue(some, "info", "doc_id has observed collision suffix", doc_id=F.col("doc_id"), title=F.col("title"), source_root=F.col("source_root")))


def registry_mismatches(ctx: AuditContext) -> tuple[DataFrame, DataFrame]:
    """Flagged documents with an asset that no fragment matches, and fragments that match no asset (CK14, JN6, JN11, JN12)."""
    hay = F.concat_ws("\n", F.coalesce("remote_url", F.lit("")), F.coalesce("local_rel_path", F.lit("")))
    assets = ctx.assets.withColumn("_hay", hay)
    tested = flagged(assets, ctx.roots.registry, ["_hay"], name="_hit").where(~F.col("_hit"))
    alone = tested.join(ctx.documents.where("affiliated").select("doc_id", "title"), "doc_id")
    c = F.col
    one = issue(alone, "warning", "Document is marked affiliated but has no registry match", doc_id=c("doc_id"), title=c("title"), local_rel_path=c("local_rel_path"), remote_url=c("remote_url"))
    unused = unmatched_entries(ctx.roots.registry, assets, "_hay")
    return counted(one.unionByName(issue(unused, "info", "Registry entry does not match any canonical asset", registry_entry=c("entry"))))


def mirror_mismatches(ctx: AuditContext) -> tuple[DataFrame, DataFrame]:
    """Mirror rows whose sides no asset has (CK15, JN10)."""
    rows = _rows(ctx.roots.mirrors)
    urls = lambda roles: ctx.assets.where(F.col("asset_role").isin(*roles) & (F.coalesce("remote_url", F.lit("")) != "")).select("remote_url").distinct()
    no_source = rows.join(urls(["primary_pdf", "external_link"]), F.col("source_url") == F.col("remote_url"), "left_anti")
    no_mirror = rows.join(urls(["mirror_pdf"]), F.col("mirror_url") == F.col("remote_url"), "left_anti")
    pair = {"source_url": F.col("source_url"), "mirror_url": F.col("mirror_url")}
    return counted(issue(no_source, "error", "Mirror registry source_url does not match any canonical primary asset", **pair).unionByName(issue(no_mirror, "error", "Mirror registry mirror_url does not match any canonical mirror asset", **pair)))


CHECKS: dict[str, Callable[[AuditContext], tuple[DataFrame, DataFrame]]] = {
    "root_inventory": root_inventory, "root_input_validation": root_input_validation, "canonical_inventory": canonical_inventory, "core_field_quality": core_field_quality, "deferred_field_status": deferred_field_status, "missing_local_files": missing_local_files,
    "orphan_files": orphan_files, "duplicate_asset_mappings": duplicate_asset_mappings, "doc_id_collisions": doc_id_collisions, "registry_mismatches": registry_mismatches, "mirror_registry_mismatches": mirror_mismatches}


def issues(ctx: AuditContext, names: list[str] | None = None) -> DataFrame:
    """All issues of the chosen checks as one frame: check, severity, message, details (AG19)."""
    return union([CHECKS[n](ctx)[0].withColumn("check", F.lit(n)) for n in names or list(CHECKS)])


def severity_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("severity").agg(F.count("*").alias("n"))  # AG4


def check_names() -> list[str]:
    """The names of all checks, sorted (SO14)."""
    return sorted(CHECKS)


def scans(ctx: AuditContext) -> dict[str, DataFrame]:
    """The canonical tables in the order in which reports read them (SO2)."""
    return {"documents": ctx.documents.orderBy("source_root", "doc_id"), "asset_refs": ctx.assets.orderBy("doc_id", "asset_id"), "document_sources": ctx.sources.orderBy("source_path", "source_row_id")}


def in_order(found: DataFrame) -> list[Column]:
    return [F.col("message"), F.to_json("details")]


def run(ctx: AuditContext, names: list[str] | None = None, most: int = 20) -> tuple[list[dict], dict[str, int]]:
    """Results for a report: of each check its summary, the number of its issues, the first ``most`` of them as a sample, and under
    ``found`` the frame of all of them, which stays distributed (``sinks.audit_json`` writes them whole)."""
    out, totals = [], {}
    for n in names or list(CHECKS):
        found, summary = CHECKS[n](ctx)
        by = {r["severity"]: r["n"] for r in severity_counts(found).collect()}
        for k, v in by.items():
            totals[k] = totals.get(k, 0) + v
        head = found.orderBy(*in_order(found)).limit(most).collect()
        out.append({"name": n, "summary": {r["key"]: r["value"] for r in summary.orderBy("key").collect()}, "issue_count": sum(by.values()), "issues": [r.asDict() for r in head], "found": found})
    return out, dict(sorted(totals.items()))
