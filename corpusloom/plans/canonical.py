"""The canonical build: three root tables to documents, sources and assets (M3)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from corpusloom.functions.text import clean, filled, first_filled, is_pdf_url, slug, stem, url_basename
from corpusloom.operators.constraints import assert_fk, assert_not_null, assert_unique
from corpusloom.operators.identity import suffixed
from corpusloom.operators.registry import flagged
from corpusloom.settings import Settings
from corpusloom.sources.places import stored
from corpusloom.sources.readers import mirror_map


@dataclass(frozen=True)
class Roots:
    """Root tables with an ordinal each, their versions and paths, and the lookups beside them."""

    portal: DataFrame
    curated_files: DataFrame
    curated_links: DataFrame
    mirrors: DataFrame
    registry: DataFrame
    inventory: DataFrame
    versions: dict[str, str]
    paths: dict[str, str]


def _have(df: DataFrame, name: str) -> Column:
    return clean(name) if name in df.columns else F.lit("")


def _common(df: DataFrame, kind: str, remote: Column, base: Column, entry_type: Column, year: Column) -> DataFrame:
    """PR1-PR3 and the id rule of a source; the raw row as JSON with nulls and key order (PR7)."""
    raw = F.to_json(F.struct(*[c for c in df.columns if c != "ordinal"]), {"ignoreNullFields": "false"})
    return df.select("ordinal", raw.alias("raw"), remote.alias("remote_url"), entry_type.alias("entry_type"), _have(df, "paper").alias("title"), _have(df, "author").alias("author_display"), year.alias("year"), _have(df, "journal").alias("journal_label"), base.alias("base"), F.lit(kind).alias("kind"))


def portal_rows(df: DataFrame, s: Settings) -> DataFrame:
    remote = first_filled(_have(df, "mirror_url"), _have(df, "url"))
    base = F.coalesce(filled(stem(url_basename(remote))), F.concat(F.lit("portal-row-"), F.format_string("%04d", "ordinal"), F.lit("-"), slug(_have(df, "paper"))))
    year = first_filled(_have(df, "year"), F.regexp_extract(_have(df, "journal"), s.journal_pattern, 1))
    return _common(df, "portal", remote, base, F.when(is_pdf_url(remote), "pdf").otherwise("link"), year)


def curated_file_rows(df: DataFrame) -> DataFrame:
    remote = _have(df, "url")
    name = url_basename(remote)
    base = F.when(name != "", stem(name)).otherwise(F.concat(F.lit("curated-file-"), F.format_string("%04d", "ordinal"), F.lit("-"), slug(_have(df, "paper"))))
    return _common(df, "curated_files", remote, base, F.lit("pdf"), _have(df, "year"))


def curated_link_rows(df: DataFrame) -> DataFrame:
    remote = _have(df, "url")
    name = url_basename(remote)
    base = F.concat(slug(first_filled(_have(df, "journal"), F.lit("link"))), F.lit("-"), slug(F.when(name != "", stem(name)).otherwise(_have(df, "paper"))))
    return _common(df, "curated_links", remote, base, F.lit("link"), _have(df, "year"))


def local_paths(rows: DataFrame, inventory: DataFrame, buckets: tuple[str, ...]) -> DataFrame:
    """The stored copy by name: buckets in their order of precedence; links have none (SC7, JN22).

    The inventory is pivoted by name first, so the rows meet it in one join."""
    rank = F.array_position(F.array(*[F.lit(b) for b in buckets]), F.col("bucket"))
    best = inventory.where(F.col("bucket").isin(*buckets)).groupBy("name").agg(F.min_by("bucket", rank).alias("_first"), F.collect_set("bucket").alias("_in"))
    out = rows.withColumn("name", url_basename("remote_url")).join(best, "name", "left")
    portal = F.concat("_first", F.lit("/"), "name")
    curated = F.when(F.array_contains("_in", buckets[-1]), F.concat(F.lit(buckets[-1] + "/"), "name"))
    return out.withColumn("local_rel_path", F.when(F.col("kind") == "portal", portal).when(F.col("kind") == "curated_files", curated)).drop("name", "_first", "_in")


def build(roots: Roots, settings: Settings | None = None, ingested_at: Column | None = None, check: bool = True) -> dict[str, DataFrame]:
    """All canonical tables. Key constraints are checked before anything is returned (SK2-SK8).

    Three sources are derived apart, united once, and enriched together: one join to the inventory, one to the mirrors. The result is
    written to the shared folder once, and all tables and key checks read it there.
    """
    s = settings or Settings()
    spark = roots.portal.sparkSession
    rows = None
    for part in (portal_rows(roots.portal, s), curated_file_rows(roots.curated_files), curated_link_rows(roots.curated_links)):
        part = suffixed(part, "base", ["ordinal"])  # ids are counted within a source; a clash between sources is an error
        rows = part if rows is None else rows.unionByName(part)
    rows = local_paths(rows, roots.inventory, s.buckets)
    links = mirror_map(roots.mirrors)
    rows = rows.join(links.withColumnRenamed("source_url", "remote_url"), "remote_url", "left")
    rows = stored(flagged(rows, roots.registry, ["remote_url", F.coalesce("local_rel_path", F.lit(""))]), "canonical")
    documents = rows.select("doc_id", "entry_type", "title", "author_display", "year", "journal_label", "affiliated", F.col("kind").alias("source_root"))
    prefix = F.create_map(F.lit("portal"), F.lit("portal"), F.lit("curated_files"), F.lit("curated-files"), F.lit("curated_links"), F.lit("curated-links"))
    pick = lambda m: F.create_map(*[x for k, v in m.items() for x in (F.lit(k), F.lit(v))])[F.col("kind")]
    at = ingested_at if ingested_at is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    sources = rows.select(F.concat(prefix[F.col("kind")], F.lit(":"), F.format_string("%05d", "ordinal")).alias("source_row_id"), "doc_id", F.concat("kind", F.lit("_metadata")).alias("source_type"), pick(roots.paths).alias("source_path"), pick(roots.versions).alias("source_version"), F.col("raw").alias("raw_metadata_json"), at.alias("ingested_at"))
    status = F.when(F.col("local_rel_path").isNotNull(), "present").otherwise("remote_only").alias("availability_status")
    asset = lambda role, key, url: (F.concat("doc_id", F.lit(key)).alias("asset_id"), "doc_id", role.alias("asset_role"), "local_rel_path", url.alias("remote_url"), F.col("local_rel_path").alias("object_key"), status)
    primary = rows.select(*asset(F.when(F.col("entry_type") == "pdf", "primary_pdf").otherwise("external_link"), ":primary", F.col("remote_url")))
    mirrored = rows.where("mirror_url is not null and kind <> 'curated_links'").select(*asset(F.lit("mirror_pdf"), ":mirror", F.col("mirror_url")))
    out = {
        "documents": documents, "document_sources": sources, "asset_refs": primary.unionByName(mirrored), "registry_entries": roots.registry.select(F.col("entry").alias("registry_key")),
        "mirror_entries": roots.mirrors.select(clean("source_url").alias("source_url"), clean("mirror_url").alias("mirror_url")),
        "build_info": spark.createDataFrame([(f"{k}_source_version", v) for k, v in roots.versions.items()], "key string, value string")}
    if check:
        verify(out)
    return out


def verify(t: dict[str, DataFrame]) -> None:
    """Raise like the constraints of a store would: unique keys, no nulls, every child with its document (D3-D7)."""
    for name, key in (("documents", "doc_id"), ("document_sources", "source_row_id"), ("asset_refs", "asset_id"), ("registry_entries", "registry_key"), ("mirror_entries", "source_url"), ("build_info", "key")):
        assert_unique(t[name], [key], name)
    assert_not_null(t["documents"], ["doc_id", "entry_type", "title", "affiliated", "source_root"], "documents")
    assert_not_null(t["document_sources"], ["source_row_id", "doc_id", "source_type", "source_path", "source_version", "raw_metadata_json", "ingested_at"], "document_sources")
    assert_not_null(t["asset_refs"], ["asset_id", "doc_id", "asset_role", "availability_status"], "asset_refs")
    for child in ("document_sources", "asset_refs"):
        assert_fk(t[child], t["documents"], "doc_id", child)


def read_roots(spark: SparkSession, paths: dict[str, str], inventory: DataFrame) -> Roots:
    """Root tables from their files, with fingerprints as versions."""
    from corpusloom.sources import readers as R

    kinds = ("portal", "curated_files", "curated_links")
    return Roots(*[R.tsv(spark, paths[k], ordinal=True) for k in kinds], R.mirrors(spark, paths["mirrors"]), R.registry(spark, paths["registry"]), inventory, {k: R.file_version(spark, paths[k]) for k in kinds}, {k: paths[k] for k in kinds})
