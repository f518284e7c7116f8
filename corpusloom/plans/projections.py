"""Index, web and featured projections, and the comparison of two index versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.functions.text import clean, clean_number, first_filled, is_float, py_int, url_host, year_token
from corpusloom.operators.diff import keyed_difference
from corpusloom.schemas import INDEX_COLUMNS, INDEX_KEY
from corpusloom.settings import Settings


def source_label(source_type: Column, url: Column, s: Settings) -> Column:
    """Portal and files have one label; links by their host; other types keep their name (PR9)."""
    link = F.when(F.contains(url_host(url), F.lit(s.link_host)), s.link_label).otherwise("curated_link")
    return F.when(source_type.isin("portal_metadata", "curated_files_metadata"), s.portal_label).when(source_type == "curated_links_metadata", link).otherwise(source_type)


def index(documents: DataFrame, sources: DataFrame, assets: DataFrame, enrichment: DataFrame, fallback: DataFrame | None = None, settings: Settings | None = None) -> DataFrame:
    """The flat index in source order, with source_path and source_row_id to sort by (JN1, JN2, JN4, PR8-PR11, SO1).

    Joins are on doc_id, so the three shuffles share one partitioning; lookups go by the four-column key, broadcast by their size.
    """
    s = settings or Settings()
    primary = assets.select(F.col("doc_id").alias("_d"), "asset_id", "remote_url", "object_key").where(F.col("asset_id") == F.concat("_d", F.lit(":primary")))
    mirror = assets.where("asset_role = 'mirror_pdf'").select(F.col("doc_id").alias("_m"), F.col("remote_url").alias("mirror_url"))
    rows = documents.join(sources.select("doc_id", "source_type", "source_path", "source_row_id", "raw_metadata_json"), "doc_id").join(primary, F.col("doc_id") == F.col("_d")).join(mirror, F.col("doc_id") == F.col("_m"), "left")
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = rows.select(blank("journal_label").alias("journal"), blank("title").alias("paper"), blank("author_display").alias("author"), blank("remote_url").alias("url"), blank("year").alias("year"), blank("mirror_url").alias("mirror_url"), F.when(F.col("affiliated"), "true").otherwise("false").alias("affiliated"), blank("entry_type").alias("entry_type"),
                       F.get_json_object("raw_metadata_json", "$.size_in_kb").alias("size"), source_label(F.col("source_type"), blank("remote_url"), s).alias("source"), blank("object_key").alias("object_key"), "source_path", "source_row_id")
    first = enrichment.select(*INDEX_KEY, F.col("subject").alias("_s1"), F.col("category").alias("_c1"))
    rows = rows.join(first, INDEX_KEY, "left")
    if fallback is not None:
        rows = rows.join(fallback.select(*INDEX_KEY, F.col("subject").alias("_s2"), F.col("category").alias("_c2")), INDEX_KEY, "left")
    else:
        rows = rows.withColumn("_s2", F.lit("")).withColumn("_c2", F.lit(""))
    known = (clean("_s1") != "") | (clean("_c1") != "")
    pick = lambda a, b: F.coalesce(F.when(known, F.col(a)).otherwise(F.col(b)), F.lit(""))
    size = F.when((F.col("entry_type") == "link") & (clean("size") == ""), "0").otherwise(F.coalesce("size", F.lit("")))
    out = rows.withColumn("subject", pick("_s1", "_s2")).withColumn("category", pick("_c1", "_c2")).withColumn("size_in_kb", size).withColumn("object_synced", F.lit("false"))
    return out.select(*INDEX_COLUMNS, "source_path", "source_row_id")


def web_records(index: DataFrame, inventory: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Typed records for search: cleaned text, numeric size, year from the journal, local path and its size (PR12-PR17)."""
    s = settings or Settings()
    default = {"title": "Untitled", "author": "Unknown", "category": "Uncategorized", "subject": "General", "entry_type": "pdf", "source": s.portal_label}
    take = lambda c, to=None: (clean_number(c) if c in index.columns else F.lit(default.get(to or c, ""))).alias(to or c)
    size = F.coalesce(F.when(is_float("size_in_kb") & ~F.lower(clean("size_in_kb")).isin("nan", "+nan", "-nan"), F.replace(clean("size_in_kb"), F.lit("_"), F.lit("")).try_cast("double")), F.lit(0.0)) if "size_in_kb" in index.columns else F.lit(0.0)
    keep = [c for c in index.columns if c in ("ordinal", "source_path", "source_row_id")]
    rows = index.select(*keep, take("journal"), take("paper", "title"), take("author"), take("category"), take("subject"), take("year"), F.coalesce("url", F.lit("")).alias("remote_url"), take("mirror_url"), size.alias("size"), (F.lower(clean("affiliated")) == "true").alias("affiliated"), take("entry_type"), take("source"), take("object_key"))
    rows = rows.withColumn("mirror_url", F.when(F.contains("remote_url", F.lit(s.mirror_token)) & (F.col("mirror_url") == ""), F.col("remote_url")).otherwise(F.col("mirror_url")))
    rows = rows.withColumn("year", F.when(F.col("year") == "", F.coalesce(year_token("journal"), F.lit(""))).otherwise(F.col("year")))
    by_key = inventory.select(F.concat("bucket", F.lit("/"), "name").alias("object_key"), F.col("bytes").alias("_bytes"))
    rank = F.array_position(F.array(*[F.lit(b) for b in s.buckets]), F.col("bucket"))
    by_name = inventory.where(F.col("bucket").isin(*s.buckets)).groupBy("name").agg(F.min_by("bucket", rank).alias("_bucket"))
    rows = rows.withColumn("_name", F.substring_index("remote_url", "/", -1)).join(by_key, "object_key", "left").join(by_name.withColumnRenamed("name", "_name"), "_name", "left")
    path = F.when(F.col("_bytes").isNotNull() & (F.col("object_key") != ""), F.concat(F.lit("assets/pdfs/"), "object_key")).when(F.col("_bucket").isNotNull(), F.concat(F.lit("assets/pdfs/"), "_bucket", F.lit("/"), "_name"))
    rows = rows.withColumn("local_path", path).withColumn("size", F.when((F.col("size") <= 0) & F.col("_bytes").isNotNull(), F.col("_bytes") / 1024).otherwise(F.col("size")))
    return rows.drop("_name", "_bytes", "_bucket")


def featured_link(row_type: Column, mirror: Column, remote: Column, prefix: str) -> Column:
    """A mirror of the lasting place, else a source there, else the link itself, else mirror or source (PR18)."""
    m, r = F.coalesce(mirror, F.lit("")), F.coalesce(remote, F.lit(""))
    return F.when(F.startswith(m, F.lit(prefix)), m).when(F.startswith(r, F.lit(prefix)), r).when(row_type == "link", r).otherwise(first_filled(m, r))


def featured(records: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Flagged records with a link, renamed, with the keys of their order: newest year, source, title (FI12, PR19, SO3)."""
    s = settings or Settings()
    rows = records.where("affiliated").withColumn("link", featured_link(F.col("entry_type"), F.col("mirror_url"), F.col("remote_url"), s.mirror_prefix)).where("link <> ''")
    return rows.select("year", first_filled("subject", F.lit("General")).alias("category"), "title", "author", F.col("journal").alias("source"), F.col("link").alias("url"), "entry_type", py_int("year").alias("sort_year"))


def featured_order() -> list[Column]:
    return [F.desc("sort_year"), F.asc("source"), F.asc("title")]


def payload(rows: DataFrame) -> DataFrame:
    """One row: number of records and the records as an array in order (AG20, D10). The featured part is small by nature."""
    fields = ["year", "category", "title", "author", "source", "url", "entry_type"]
    keyed = F.struct((-F.col("sort_year")).alias("k1"), F.col("source").alias("k2"), F.col("title").alias("k3"), F.struct(*fields).alias("r"))
    out = rows.agg(F.count("*").alias("row_count"), F.transform(F.array_sort(F.collect_list(keyed)), lambda x: x["r"]).alias("rows"))
    return out.select(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("generated_at"), "row_count", "rows")


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, and the filled values of each column (AG8)."""
    return df.agg(F.count("*").alias("n"), *[F.count_if(clean(c) != "").alias(f"n_{c}") for c in columns])


def compare(exported: DataFrame, former: DataFrame, most: int = 20) -> dict:
    """Row counts, headers, types, coverage and keyed differences of two versions (CK16, AG8-AG10, ST1, SO10)."""
    def facts(df: DataFrame) -> tuple:
        one = coverage(df, ["subject", "category"]).first()
        return one["n"], {c: one[f"n_{c}"] for c in ("subject", "category")}, {r["entry_type"]: r["count"] for r in df.groupBy(F.coalesce("entry_type", F.lit("")).alias("entry_type")).count().orderBy("entry_type").collect()}

    a, b = facts(exported), facts(former)
    apart = keyed_difference(former, exported, INDEX_KEY)
    n = {r["side"]: r["count"] for r in apart.groupBy("side").count().collect()}
    head = lambda side: [r.asDict() for r in apart.where(F.col("side") == side).drop("side").orderBy(*INDEX_KEY).limit(most).collect()]
    return {"rows": (a[0], b[0]), "same_header": exported.columns == former.columns, "types": (a[2], b[2]), "subject": (a[1]["subject"], b[1]["subject"]), "category": (a[1]["category"], b[1]["category"]), "n_missing": n.get("missing", 0), "n_extra": n.get("extra", 0), "missing": head("missing"), "extra": head("extra")}
