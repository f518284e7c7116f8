"""Table shapes of the canonical model, all text unless said otherwise."""

from __future__ import annotations

from pyspark.sql import types as T


def text_table(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


ROOT_HEADERS = {
    "portal": ["journal", "paper", "url", "size_in_kb", "author"],
    "curated_files": ["journal", "paper", "url", "size_in_kb", "year", "author"],
    "curated_links": ["journal", "paper", "url", "year", "author"],
    "mirrors": ["source_url", "mirror_url"],
}
DOCUMENTS = T.StructType([T.StructField(n, T.StringType()) for n in ("doc_id", "entry_type", "title", "author_display", "year", "journal_label")] + [T.StructField("affiliated", T.BooleanType()), T.StructField("source_root", T.StringType())])
SOURCES = text_table("source_row_id", "doc_id", "source_type", "source_path", "source_version", "raw_metadata_json", "ingested_at")
ASSETS = text_table("asset_id", "doc_id", "asset_role", "local_rel_path", "remote_url", "object_key", "availability_status")
INVENTORY = T.StructType([T.StructField("bucket", T.StringType()), T.StructField("name", T.StringType()), T.StructField("bytes", T.LongType())])
INDEX_COLUMNS = ["journal", "paper", "subject", "category", "author", "url", "size_in_kb", "year", "mirror_url", "affiliated", "entry_type", "source", "object_key", "object_synced"]
CLASSIFIED_COLUMNS = INDEX_COLUMNS[:10]
INDEX_KEY = ["journal", "paper", "url", "entry_type"]
