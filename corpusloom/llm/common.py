"""Helpers shared by the training-data operators: stored intermediate tables, row identity, graph components."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

_OWN: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir`` of the session; one of our own where it is unset and all runs
    on this machine."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="corpusloom-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _drop_stored() -> None:
    for spark, path in _OWN:
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001  the session is gone: its folder is the cluster's to clean
            pass
    _OWN.clear()


atexit.register(_drop_stored)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared one; it is deleted when the driver ends, or by ``freed``."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    _OWN.append((spark, path))
    return path


def mark() -> int:
    """The number of folders so far, for ``freed``."""
    return len(_OWN)


def freed(since: int, but: int = 0) -> None:
    """Delete the folders made since a mark, but for the last ``but`` ones: nothing reads them any more."""
    gone = _OWN[since : len(_OWN) - but]
    del _OWN[since : len(_OWN) - but]
    for spark, path in gone:
        _delete(spark, path)


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here, so a lost executor costs nothing above it."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def set_aside(df: DataFrame, *reserved: str) -> tuple[DataFrame, list]:
    """``df`` with the columns renamed that an operator uses for itself (names differ in more than case), and the columns that
    give the old frame back. The new names are none of the frame's and none of the reserved ones, whatever these are."""
    taken, names = {r.lower() for r in reserved}, {c.lower() for c in df.columns}
    away: dict[str, str] = {}
    for c in df.columns:
        if c.lower() in taken:
            new = f"_own_{c}"
            while new.lower() in names | taken:
                new = f"_{new}"
            names.add(new.lower())
            away[c] = new
    return df.withColumnsRenamed(away), [F.col(f"`{away.get(c, c)}`").alias(c) for c in df.columns]


def crc_of_id(col: str = "doc_id"):
    """Unsigned CRC-32 of an identifier written as text; null counts as an empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")))


HUB, MOST_HUBS = 256, 10_000


def hub_join(edges: DataFrame, low: DataFrame, count: int) -> DataFrame:
    """``edges(a, b)`` with m of the one row of ``low(a, m, n)`` for each a, where n is the number of its edges.

    Nodes of more than one in 10,000 of ``count`` edges (and of more than 256) are broadcast, so a hub's edges stay where they
    are; the others are joined by equality. At most 20,000 rows are broadcast, however many edges there are: their numbers
    of edges add up to twice the count at most.
    """
    least = max(HUB, count // MOST_HUBS)
    if count <= least:
        return edges.join(low.select("a", "m"), "a")
    big = low.where(F.col("n") > least).select("a", "m")
    rest = edges.join(F.broadcast(big.select("a")), "a", "left_anti").join(low.where(F.col("n") <= least).select("a", "m"), "a")
    return edges.join(F.broadcast(big), "a").unionByName(rest)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for each node of ``edges(a, b)``; root is the smallest node of its component.

    Alternating large-star and small-star rounds. A round is two aggregations with map-side combine and two joins that take
    hubs apart, so a hub with very many links neither meets in one task nor reaches the driver. Each round
    is stored; the rounds end when the set of edges no longer changes (count and order-free checksum). Their number grows with the
    logarithm of the longest path; after ``max_rounds`` an error is raised.
    """
    sum_of = lambda d: d.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = sum_of(now)
    for _ in range(max_rounds):
        if not before["n"]:
            break
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n"))
        large = hub_join(both.where("b > a"), low, before["n"]).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.where("a <> b").distinct(), "large")
        low = large.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        small = hub_join(large, low, before["n"]).select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*")
        now = stored(small.where("a <> b").distinct(), "small")
        after = sum_of(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
