"""Derived tables beside the canonical ones: text chunks, a term index over them, curated overrides, and what a new version makes stale."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusloom.functions.python import folding
from corpusloom.functions.text import url_basename
from corpusloom.settings import Settings


def chunk_texts(docs: DataFrame, size: int = 1000, overlap: int = 100, version: str = "c1", extract_version: str = "e1", key: str = "doc_id", text: str = "text") -> DataFrame:
    """Chunks of ``size`` characters, each sharing ``overlap`` with the one before: chunk_id, key, chunk_index, chunk_text, char_start,
    char_end, chunk_version, extract_version. A text is cut once into strides, so the work grows with its length alone.
    Null and empty texts have no chunks."""
    stride = size - overlap
    if not 0 <= overlap <= stride:
        raise ValueError("the overlap is at most half of a chunk")
    pieces = F.regexp_extract_all(F.col(text), F.lit(rf"((?s).{{1,{stride}}})"), 1)
    n = F.greatest(F.ceil((F.length(text) - size) / stride), F.lit(0)).cast("int") + 1
    rows = docs.where(F.length(text) > 0).select(key, pieces.alias("_p"), n.alias("_n"))
    made = F.transform(F.slice("_p", F.lit(1), F.col("_n")), lambda p, i: F.concat(p, F.left(F.coalesce(F.get("_p", i + 1), F.lit("")), F.lit(overlap))))
    out = rows.select(key, F.posexplode(made).alias("chunk_index", "chunk_text"))
    start = F.col("chunk_index") * stride
    return out.select(F.concat_ws(":", F.col(key).cast("string"), F.lit(version), F.format_string("%05d", "chunk_index")).alias("chunk_id"), key, "chunk_index", "chunk_text", start.alias("char_start"), (start + F.length("chunk_text")).alias("char_end"), F.lit(version).alias("chunk_version"), F.lit(extract_version).alias("extract_version"))


def terms(text: str):
    """Words of letters and digits, without accents and case."""
    marked, plain = folding()
    return F.regexp_extract_all(F.lower(F.translate(text, marked, plain)), F.lit("([a-z0-9]+)"), 1)


def term_index(chunks: DataFrame, key: str = "chunk_id", text: str = "chunk_text") -> DataFrame:
    """Postings as rows: term, key, tf. A term of every chunk is as many rows and never one array."""
    return chunks.select(key, F.explode(terms(text)).alias("term")).groupBy("term", key).agg(F.count("*").alias("tf"))


def term_statistics(postings: DataFrame) -> DataFrame:
    """Chunks that hold a term, and its occurrences."""
    return postings.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


def term_search(postings: DataFrame, words: list[str], key: str = "chunk_id") -> DataFrame:
    """Chunks that hold all words, with the sum of their occurrences: the filter reaches the postings, each key meets a few rows."""
    wanted = sorted({w.lower() for w in words})
    found = postings.where(F.col("term").isin(*wanted)).groupBy(key).agg(F.count("*").alias("_n"), F.sum("tf").alias("score"))
    return found.where(F.col("_n") == len(wanted)).drop("_n")


def overridden(table: DataFrame, overrides: DataFrame, name: str, key: str = "doc_id", source: str = "source_root") -> DataFrame:
    """``table`` with the fields that ``overrides`` (override_id, key, target_table, target_field, override_value_json,
    applies_to_source_type, created_at) replace.

    The value is a JSON scalar and takes the field's type; a JSON null empties the field. Of several overrides of a field the latest
    holds, by created_at and then id; one that names a source type applies to rows of that source alone. The key isn't a field: an override of it, or of a field
    that isn't there, raises.
    """
    fields = [c for c in table.columns if c != key]
    mine = overrides.where(F.col("target_table") == name)
    bad = [r[0] for r in mine.select("target_field").distinct().where(~F.col("target_field").isin(*fields)).limit(5).collect()]
    if bad:
        raise ValueError(f"{name}: no override for {bad}")
    rows = table.select(key, F.col(source).alias("_source")) if source in fields else table.select(key, F.lit(None).cast("string").alias("_source"))
    fits = mine.join(rows.withColumnRenamed(key, "_key"), F.col(key) == F.col("_key")).where(F.col("applies_to_source_type").isNull() | F.col("applies_to_source_type").eqNullSafe(F.col("_source")))
    value = F.struct(F.get_json_object(F.concat(F.lit('{"v":'), "override_value_json", F.lit("}")), "$.v").alias("v"))
    at = F.struct("created_at", "override_id")
    picked = fits.groupBy(F.col("_key").alias(key)).agg(*[F.max_by(F.when(F.col("target_field") == c, value), F.when(F.col("target_field") == c, at)).alias(f"_o_{c}") for c in fields])
    out = table.join(picked, key, "left")
    return out.select(key, *[F.when(F.col(f"_o_{c}").isNotNull(), F.col(f"_o_{c}")["v"].cast(table.schema[c].dataType)).otherwise(F.col(c)).alias(c) for c in fields])


def row_versions(df: DataFrame, key: str) -> DataFrame:
    """The key and a fingerprint of each whole row: 8 hex digits of the SHA-256 of its JSON, nulls kept."""
    return df.select(key, F.substring(F.sha2(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}), 256), 1, 8).alias("version"))


def stale(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Keys to rebuild: ``added``, ``changed`` or ``removed`` since the versions ``before``; one shuffle for both."""
    both = before.select(key, F.col("version").alias("_a"), F.lit(None).cast("string").alias("_b")).unionAll(after.select(key, F.lit(None).cast("string").alias("_a"), F.col("version").alias("_b")))
    met = both.groupBy(key).agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    state = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(F.col("_a") != F.col("_b"), "changed")
    return met.select(key, state.alias("state")).where("state is not null")


def rebuilt(kept: DataFrame, fresh: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """A derived table after a change: rows of untouched keys as they were, those of added and changed keys anew."""
    touched = changes.select(key)
    return kept.join(touched, key, "left_anti").unionByName(fresh.join(changes.where("state <> 'removed'").select(key), key, "left_semi"))


def flagged_without_copy(documents: DataFrame, assets: DataFrame, inventory: DataFrame, settings: Settings | None = None) -> DataFrame:
    """Advisory: flagged documents whose link to the lasting place names a file that the second bucket lacks."""
    s = settings or Settings()
    links = assets.where(F.startswith("remote_url", F.lit(s.mirror_prefix))).select("doc_id", "remote_url", url_basename("remote_url").alias("name"))
    there = inventory.where(F.col("bucket") == s.buckets[1]).select("name").distinct()
    return links.join(documents.where("affiliated").select("doc_id"), "doc_id", "left_semi").join(there, "name", "left_anti").select("doc_id", "remote_url")
