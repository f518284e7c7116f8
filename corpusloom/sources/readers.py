"""Scans: delimited tables, registries, mirrors, file inventories, listings in markdown and HTML, saved searches."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from pathlib import Path
from urllib.parse import parse_qs

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from corpusloom.functions.text import clean, py_strip
from corpusloom.operators.identity import keep_last, with_ordinal
from corpusloom.schemas import INVENTORY, text_table
from corpusloom.settings import Settings


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def _tsv(spark: SparkSession):
    return spark.read.option("sep", "\t").option("quote", '"').option("escape", '"').option("multiLine", True).option("encoding", "UTF-8")


def headers(spark: SparkSession, path: str) -> list[str]:
    """Field names in file order (SC2)."""
    return _tsv(spark).option("header", True).option("inferSchema", False).csv(path).columns


def tsv(spark: SparkSession, path: str, ordinal: bool = False) -> DataFrame:
    """All columns as text; blank lines are skipped and short rows filled with null (SC1, SC12, SC13, SC20).

    With ``ordinal``, 1-based places of the data rows (SC3)."""
    df = _tsv(spark).option("header", True).schema(text_table(*headers(spark, path))).csv(path)
    return with_ordinal(df) if ordinal else df


def registry(spark: SparkSession, path: str) -> DataFrame:
    """One fragment a line, stripped; blank lines and comments go, order and repeats stay (SC4)."""
    rows = with_ordinal(spark.read.text(path)).select("ordinal", py_strip("value").alias("entry"))
    return rows.where((F.col("entry") != "") & ~F.startswith("entry", F.lit("#")))


def mirrors(spark: SparkSession, path: str) -> DataFrame:
    """Source and mirror URLs with their place; a file that isn't there is an empty table (SC5)."""
    if not exists(spark, path):
        return spark.createDataFrame([], "source_url string, mirror_url string, ordinal long")
    return tsv(spark, path, ordinal=True).select("source_url", "mirror_url", "ordinal")


def mirror_map(rows: DataFrame) -> DataFrame:
    """One mirror for each source URL: the last row with both sides filled wins (JN3)."""
    both = rows.select(clean("source_url").alias("source_url"), clean("mirror_url").alias("mirror_url"), "ordinal").where("source_url <> '' and mirror_url <> ''")
    return both.groupBy("source_url").agg(F.max_by("mirror_url", "ordinal").alias("mirror_url"))


def inventory(spark: SparkSession, roots: dict[str, str], glob: str = "*.pdf") -> DataFrame:
    """(bucket, name, bytes) of the files of each bucket's folder; contents aren't read (SC6, SC18)."""
    parts = [
        spark.read.format("binaryFile").option("pathGlobFilter", glob).load(root).select(F.lit(bucket).alias("bucket"), F.substring_index("path", "/", -1).alias("name"), F.col("length").alias("bytes"))
        for bucket, root in roots.items() if exists(spark, root)]
    out = spark.createDataFrame([], INVENTORY)
    for p in parts:
        out = out.unionByName(p)
    return out


def known_names(spark: SparkSession, roots: list[str], suffix: str = ".pdf") -> DataFrame:
    """Lower-cased names of all files below the roots (SC17)."""
    found = [r for r in roots if exists(spark, r)]
    if not found:
        return spark.createDataFrame([], "name string")
    names = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(found).select(F.lower(F.substring_index("path", "/", -1)).alias("name"))
    return names.where(F.endswith("name", F.lit(suffix))).distinct()


def file_version(spark: SparkSession, path: str) -> str:
    """First 8 hex digits of the SHA-256 of a file's bytes (SC8)."""
    return spark.read.format("binaryFile").load(path).select(F.substring(F.sha2("content", 256), 1, 8)).first()[0]


def remote_listing(rows: DataFrame) -> DataFrame:
    """Object names by their last segment; of equal ones the last by full name stays (SC19)."""
    rows = rows.where(~F.endswith("name", F.lit("/"))).select(F.substring_index("name", "/", -1).alias("base"), "name", "bytes")
    return rows.groupBy("base").agg(F.max_by("bytes", "name").alias("bytes")).withColumnRenamed("base", "name")


def enrichment(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Optional lookup by ``keys``; the last of equal keys wins; a missing file is an empty table (SC10)."""
    shape = ", ".join(f"{k} string" for k in [*keys, "subject", "category"])
    if not exists(spark, path):
        return spark.createDataFrame([], shape)
    rows = tsv(spark, path, ordinal=True).select(*[F.coalesce(k, F.lit("")).alias(k) for k in [*keys, "subject", "category"]], "ordinal")
    return last_by_key(rows, keys)


def last_by_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """subject and category of the last row of each key, by ordinal (SC10, WN3)."""
    return keep_last(rows, keys, ["ordinal"], ["subject", "category"])


def constant_lookup(spark: SparkSession, rows: tuple, keys: list[str]) -> DataFrame:
    """A small table from settings: tuples of the keys, subject and category (SC11)."""
    return spark.createDataFrame(list(rows), ", ".join(f"{k} string" for k in [*keys, "subject", "category"]))


# ---- listings


def lines(spark: SparkSession, path: str) -> DataFrame:
    return with_ordinal(spark.read.text(path)).withColumnRenamed("value", "line")


def cells(line: str = "line"):
    """Cells between the outer pipes, stripped (FN30)."""
    parts = F.split(F.col(line), r"\|")
    return F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 2, F.lit(0))), lambda c: py_strip(c))


def named_listing(rows: DataFrame, marker: str = Settings.listing_marker, names: tuple[str, ...] = ("Journal", "Paper", "Author")) -> DataFrame:
    """A markdown table whose columns are found by name in its header line (SC15): ordinal, one column a name, title, line.

    Rows before the header, separators, lines that don't begin with a pipe and rows with too few cells are left out. The
    title is the text of a link where the cell has one. An empty table results where a name is missing.
    """
    head = rows.where(F.contains("line", F.lit(marker))).orderBy("ordinal").limit(1).collect()
    shape = T.StructType([T.StructField("ordinal", T.LongType()), *text_table(*[n.lower() for n in names], "title", "line").fields])
    if not head:
        return rows.sparkSession.createDataFrame([], shape)
    found = [h.strip() for h in head[0]["line"].split("|") if h.strip()]
    if any(n not in found for n in names):
        return rows.sparkSession.createDataFrame([], shape)
    at = {n: found.index(n) for n in names}
    body = rows.where((F.col("ordinal") > head[0]["ordinal"]) & ~F.contains("line", F.lit("|---")) & F.startswith(py_strip("line"), F.lit("|")) & ~F.contains("line", F.lit(marker))).withColumn("cells", cells())
    body = body.where(F.size("cells") > max(at.values()))
    paper = F.col("cells")[at[names[1]]]
    linked = F.regexp_extract(paper, r"\[(.*?)\]\(.*?\)", 1)
    return body.select("ordinal", *[F.col("cells")[i].alias(n.lower()) for n, i in at.items()], F.when(paper.rlike(r"\[(.*?)\]\(.*?\)"), linked).otherwise(paper).alias("title"), py_strip("line").alias("line"))


def marked_listing(rows: DataFrame, marker: str, skip: int = 1) -> DataFrame:
    """Cells by place of the lines after a marker line, up to the first line without a pipe; ``skip`` lines go first (SC16)."""
    start = rows.where(F.contains("line", F.lit(marker))).agg(F.min("ordinal")).first()[0]
    if start is None:
        return rows.select("ordinal", cells().alias("cells")).limit(0)
    after = rows.where((F.col("ordinal") > start) & ~F.contains("line", F.lit(marker)))
    begin = after.where(F.contains("line", F.lit("|"))).agg(F.min("ordinal")).first()[0]
    if begin is None:
        return rows.select("ordinal", cells().alias("cells")).limit(0)
    stop = after.where((F.col("ordinal") > begin) & ~F.contains("line", F.lit("|"))).agg(F.min("ordinal")).first()[0]
    body = after.where((F.col("ordinal") >= begin) & F.contains("line", F.lit("|")))
    body = body.where(F.col("ordinal") < stop) if stop is not None else body
    place = F.row_number().over(W.orderBy("ordinal"))
    return body.withColumn("_n", place).where(F.col("_n") > skip).select("ordinal", cells().alias("cells"))


def linked(c):
    """(title, url) of a markdown link, stars around the title dropped; (text, null) without one (PR26)."""
    pattern = r"\[\**(.+?)\**\]\((.+?)\)"
    there = c.rlike(pattern)
    return F.struct(F.when(there, py_strip(F.regexp_extract(c, pattern, 1))).otherwise(c).alias("title"), F.when(there, py_strip(F.regexp_extract(c, pattern, 2))).alias("url"))


def html_listing(spark: SparkSession, path: str, base: str, journal_name: str, journal_code: str) -> DataFrame:
    """journal, paper, author and url of each entry of saved listing pages (SC14, PR23, PR25).

    An entry is a link inside an element of class ``question col-xs-11``; the author is the text of the second element after
    it; the journal comes from the cells of the table inside ``col-xs-8``. Relative links are made absolute, spaces encoded;
    of equal URLs the first stays. Pages are read whole, one row each.
    """
    pages = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("html"))
    cells_ = F.regexp_extract_all(F.regexp_extract("html", r'(?s)class="col-xs-8".*?<tbody>(.*?)</tbody>', 1), F.lit(r"(?s)<td[^>]*>(.*?)</td>"), 1)
    journal = F.regexp_replace(F.replace(F.array_join(cells_, "-"), F.lit(journal_name), F.lit(journal_code)), r"\s+", "-")
    parts = F.split("html", r'(?=<\w+[^>]*class="question col-xs-11")')
    entries = pages.select("file", journal.alias("journal"), F.posexplode(parts).alias("at", "part")).where(F.contains("part", F.lit('class="question col-xs-11"')))
    href = F.regexp_extract("part", r'(?s)<a[^>]*href="([^"]*)"[^>]*>(.*?)</a>', 1)
    paper = F.regexp_extract("part", r'(?s)<a[^>]*href="([^"]*)"[^>]*>(.*?)</a>', 2)
    author = F.regexp_extract("part", r"(?s)</a>.*?</\w+>\s*<(\w+)[^>]*>.*?</\1>\s*<(\w+)[^>]*>(.*?)</\2>", 3)
    out = entries.select("file", "at", "journal", paper.alias("paper"), author.alias("author"), href.alias("href")).where("href <> ''")
    out = out.withColumn("url", F.concat(F.lit(base), F.replace(F.replace("href", F.lit(".."), F.lit("")), F.lit(" "), F.lit("%20"))))
    first = F.row_number().over(W.partitionBy("url").orderBy("file", "at"))
    return out.withColumn("_n", first).where("_n = 1").select("journal", "paper", "author", "url")


# ---- places and requests


def asset_root(candidates: list[str | None], buckets: tuple[str, ...] = ("main", "other")) -> str:
    """The first candidate folder with all buckets, else the first candidate (SC21). Ordinary configuration, on the driver."""
    given = list(dict.fromkeys(os.path.expanduser(c) for c in candidates if c))
    return next((c for c in given if all((Path(c) / b).exists() for b in buckets)), given[0])


@dataclass
class SearchRequest:
    """A browser's filter state (SC23)."""

    search: str = ""
    regex: bool = False
    categories: list[str] = field(default_factory=list)
    subjects: list[str] = field(default_factory=list)
    decades: list[str] = field(default_factory=list)
    affiliated_only: bool = False
    sort: str = "newest"
    embedded: bool = False
    theme: str | None = None
    limit: int = 100

    @classmethod
    def from_query(cls, query: str, flags: tuple[str, ...] = ("affiliated",)) -> SearchRequest:
        given = {k: v[0] for k, v in parse_qs(query.lstrip("?"), keep_blank_values=True).items()}
        many = lambda k: [x.strip() for x in given.get(k, "").split(",") if x.strip()]
        return cls(search=given.get("search", ""), categories=many("category"), subjects=many("subject"), affiliated_only=any(given.get(f) == "1" for f in flags),
                   embedded=given.get("embed") == "1", theme=given["theme"] if given.get("theme") in ("light", "dark") else None)


def web_payload(spark: SparkSession, path: str) -> DataFrame:
    """Search records from JSON lines (SC22)."""
    return spark.read.json(path)


def recent_searches(df: DataFrame, column: str = "saved", most: int = 8) -> DataFrame:
    """Saved searches of each row as checked entries; what isn't an array of objects with a text query is dropped (SC24)."""
    item = "array<struct<query:string,useRegex:boolean,ts:double>>"
    found = F.filter(F.from_json(F.col(column), item), lambda x: x.isNotNull() & x["query"].isNotNull())
    made = F.transform(found, lambda x: F.struct(x["query"].alias("query"), F.coalesce(x["useRegex"], F.lit(False)).alias("use_regex"), F.coalesce(x["ts"], F.lit(0.0)).alias("ts")))
    return df.withColumn("recent", F.coalesce(F.slice(made, 1, most), F.array()))
