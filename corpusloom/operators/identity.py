"""Row identity: ordinals, collision suffixes, and which of equal keys is kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T


def with_ordinal(df: DataFrame, name: str = "ordinal") -> DataFrame:
    """1-based place of each row of a file scan, in file and block order (SC3).

    Rows are numbered within their block, and blocks get offsets from their counts (one row each): no single task, no sort.
    """
    marked = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")).withColumn("_at", F.monotonically_increasing_id())
    blocks = marked.groupBy("_file", "_block").agg(F.count("*").alias("_n"), F.min("_at").alias("_first")).orderBy("_file", "_block").collect()
    offsets, seen = [], 0
    for b in blocks:
        offsets.append((b["_file"], b["_block"], seen - b["_first"]))
        seen += b["_n"]
    table = df.sparkSession.createDataFrame(offsets, "_file string, _block long, _shift long")
    return marked.join(F.broadcast(table), ["_file", "_block"]).withColumn(name, F.col("_at") + F.col("_shift") + 1).drop("_file", "_block", "_at", "_shift")  # a row for each block of the scan


BLOCK = 65_536


def suffixed(df: DataFrame, base: str, order: list[Column | str], name: str = "doc_id") -> DataFrame:
    """The second and further rows of a base id get -02, -03 and so on, by order (WN1).

    By one whole-number column, rows are numbered inside blocks of that column and blocks get offsets from their counts, so
    a base with a third of all rows is no task of its own; by any other order each base is a window.
    """
    if len(order) == 1 and isinstance(order[0], str) and isinstance(df.schema[order[0]].dataType, T.IntegralType):
        dealt = df.withColumn("_block", F.floor(F.col(order[0]) / F.lit(BLOCK)).cast("long"))
        counts = dealt.groupBy(base, "_block").agg(F.count("*").alias("_n"))
        before = F.sum("_n").over(W.partitionBy(base).orderBy(F.col("_block").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1))
        offsets = counts.select(F.col(base).alias("_base"), F.col("_block").alias("_b"), F.coalesce(before, F.lit(0)).alias("_before"))
        dealt = dealt.join(offsets, F.col(base).eqNullSafe(F.col("_base")) & F.col("_block").eqNullSafe(F.col("_b")))
        n = F.col("_before") + F.row_number().over(W.partitionBy(base, "_block").orderBy(order[0]))
        return dealt.withColumn("_n", n).withColumn(name, F.when(F.col("_n") == 1, F.col(base)).otherwise(F.format_string("%s-%02d", F.col(base), F.col("_n")))).drop("_base", "_b", "_block", "_before", "_n")
    n = F.row_number().over(W.partitionBy(base).orderBy(*order))
    return df.withColumn(name, F.when(n == 1, F.col(base)).otherwise(F.format_string("%s-%02d", F.col(base), n)))


def keep(df: DataFrame, keys: list[Column | str], order: list[Column | str]) -> DataFrame:
    """The first row of each key by order: first, last or preferred, as the order says (WN2, WN3, WN4)."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def keep_last(df: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """Keys and ``values`` of the last row of each key by order (WN3): an aggregate, so the maps combine before the shuffle."""
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_v"))
    return last.select(*keys, "_v.*")


def keep_filled(df: DataFrame, key: str, order: list[Column | str]) -> DataFrame:
    """As ``keep``, but rows whose key is null or blank are all kept (WN2, WN4)."""
    blank = F.coalesce(F.trim(F.col(key)), F.lit("")) == ""
    return keep(df.where(~blank), [key], order).unionByName(df.where(blank))


def seen_before(df: DataFrame, keys: list[Column | str], order: list[Column | str], name: str = "seen_before") -> DataFrame:
    """Has a row with these keys come before, by order? (WN5) The first of each key is an aggregate with map-side combine, joined
    back, so a key with very many rows isn't sorted in one task."""
    at = [F.col(k) if isinstance(k, str) else k for k in keys]
    place = F.struct(*order)
    first = df.groupBy(*[k.alias(f"_k{i}") for i, k in enumerate(at)]).agg(F.min(place).alias("_first"))
    met = df.join(first, [k.eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(at)], "left")
    return met.withColumn(name, place != F.col("_first")).drop("_first", *[f"_k{i}" for i in range(len(at))])


def duplicated(df: DataFrame, keys: list[Column | str], name: str = "duplicated") -> DataFrame:
    """Every member of a group of more than one (WN6): counted with map-side combine, then joined back."""
    at = [F.col(k) if isinstance(k, str) else k for k in keys]
    many = df.groupBy(*[k.alias(f"_k{i}") for i, k in enumerate(at)]).agg(F.count("*").alias("_n")).where("_n > 1")
    met = df.join(many, [k.eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(at)], "left")
    return met.withColumn(name, F.col("_n").isNotNull()).drop("_n", *[f"_k{i}" for i in range(len(at))])


def row_numbers(df: DataFrame, order: str, within: list[str] | None = None, name: str = "row_number", ranges: int | None = None) -> DataFrame:
    """1-based places by a whole-number column, over all rows or within keys, without a task that holds a whole key.

    Rows are dealt into ranges of the column at approximate quantiles; counts per key and range (few rows) give each range its
    offset, and rows are numbered inside it. Nulls come first.
    """
    spark, within = df.sparkSession, within or []
    n = ranges or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = sorted(set(df.agg(F.percentile_approx(order, [i / n for i in range(1, n)], 20 * n)).first()[0] or []))
    place = F.coalesce(F.size(F.filter(F.array(*[F.lit(x) for x in cuts]), lambda x: x < F.col(order))), F.lit(0)) if cuts else F.lit(0)
    dealt = df.withColumn("_range", F.when(F.col(order).isNull(), -1).otherwise(place))
    counts = dealt.groupBy(*within, "_range").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy(*within).orderBy("_range").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.select(*[F.col(k).alias(f"_k_{k}") for k in within], F.col("_range").alias("_r"), F.coalesce(before, F.lit(0)).alias("_before"))
    met = dealt.join(offsets, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in within] + [F.col("_range") == F.col("_r")])
    inside = F.row_number().over(W.partitionBy(*within, "_range").orderBy(F.col(order).asc_nulls_first()))
    return met.withColumn(name, F.col("_before") + inside).drop("_range", "_r", "_before", *[f"_k_{k}" for k in within])


def batched(df: DataFrame, order: str, size: int = 15, name: str = "batch", within: list[str] | None = None) -> DataFrame:
    """Consecutive batches of ``size`` rows, over all rows or within keys (WN7)."""
    return row_numbers(df, order, within, "_place").withColumn(name, F.floor((F.col("_place") - 1) / size).cast("bigint")).drop("_place")


def numbered(df: DataFrame, order: list[Column | str], name: str = "row_number") -> DataFrame:
    """Row numbers over a final, small listing (WN8)."""
    return df.withColumn(name, F.row_number().over(W.orderBy(*order)))


def samples(df: DataFrame, kind: list[str], order: list[Column | str], most: int = 20, name: str | None = None) -> DataFrame:
    """The first rows of each kind (WN9), with their places under ``name`` if one is given. Each task keeps the first ones it
    has before the shuffle (a group limit on the row number)."""
    out = df.withColumn("_n", F.row_number().over(W.partitionBy(*kind).orderBy(*order))).where(F.col("_n") <= most)
    return out.withColumnRenamed("_n", name) if name else out.drop("_n")
