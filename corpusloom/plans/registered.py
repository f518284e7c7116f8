"""What the registered queries share: their registry, table loading, and SQL pieces that say the same as column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from corpusloom.settings import Settings

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
S = Settings()


def query(sql: str | None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


c = F.col


def digest(text, name: str | None = None):
    """A text as a key: 32 bytes are shuffled and compared instead of the text."""
    return F.unhex(F.sha2(text, 256)).alias(name or text)


# SQL pieces: the same patterns on both sides
BARE = r"regexp_replace(regexp_replace(regexp_replace({0}, '[?#].*$', ''), '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/]*)?', ''), ';[^/]*$', '')"
BASE = "regexp_extract(" + BARE + ", '([^/]*)/*$', 1)"
STEM = r"coalesce(nullif(regexp_extract({0}, '^(.+)\.[^.]+$', 1), ''), {0})"
HOST = r"lower(regexp_extract({0}, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1))"
SLUG = "coalesce(nullif(trim(regexp_replace(lower({0}), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'untitled')"
PAGE_NAME = BASE.format("url")
PAGE_STEM = STEM.format(PAGE_NAME)
AFFILIATED = "exists (select 1 from benchmark b where ltrim(b.text, '$') <> '' and contains(d.text, ltrim(b.text, '$')))"
NORM = "regexp_replace(lower({0}), '[^a-z0-9]', '', 'g')"
SPACE = "regexp_replace(trim(lower({0})), '\\s+', ' ', 'g')"
PAPERS = "papers as (select p_partkey as id, p_name as title, p_type as subject, p_brand as category, (1950 + p_size)::varchar as year, 'Issue-' || (p_partkey % 7) as journal, p_partkey % 5 = 0 as affiliated, p_retailprice as size from part)"
