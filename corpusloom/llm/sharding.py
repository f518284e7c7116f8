"""Contiguous shards of near equal bytes, cut from global prefix sums (operator 3)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.common import load, set_aside, stored, width

OVERHEAD = 16


def _placing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of a range in order, with their place and the bytes up to and with each: one pass that carries two numbers."""
    rows = size = 0
    for batch in batches:
        own = batch.column(batch.schema.get_field_index("_size")).to_numpy()
        upto = size + np.cumsum(own)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.arange(rows, rows + len(own)), pa.int64()), pa.array(upto, pa.int64())], [*batch.schema.names, "_pos", "_upto"])
        rows, size = rows + len(own), int(upto[-1]) if len(own) else size


def _cut(rows: DataFrame, n_shards: int, order: list[str]) -> DataFrame:
    """``rows`` with _size and ``order`` columns, and shard and slot of each."""
    spark = rows.sparkSession
    n = 2 * width(spark)
    by = [F.col(c).asc_nulls_first() for c in [*order, "_any"]]
    dealt = rows.withColumn("_any", F.xxhash64(F.monotonically_increasing_id())).repartitionByRange(n, *by).sortWithinPartitions(*by).drop("_any").withColumn("_range", F.spark_partition_id())
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema.fields)
    placed = stored(dealt.mapInArrow(_placing, f"{shape}, _pos long, _upto long"), "placed")
    totals = placed.groupBy("_range").agg(F.count("*").alias("n"), F.sum("_size").alias("b")).orderBy("_range").collect()  # a row for each range
    whole = sum(t["b"] for t in totals)
    offsets, at, size = [], 0, 0
    for t in totals:
        offsets.append((t["_range"], at, size))
        at, size = at + t["n"], size + t["b"]
    placed = placed.join(F.broadcast(spark.createDataFrame(offsets, "_range int, _row0 long, _byte0 long")), "_range")  # at most 2 x the shuffle partitions
    middle = (2 * (F.col("_byte0") + F.col("_upto")) - F.col("_size")).cast("decimal(38,0)") * n_shards
    placed = placed.withColumn("_shard", F.least(F.lit(n_shards - 1), F.floor(middle / F.lit(2 * max(whole, 1)).cast("decimal(38,0)")).cast("int")))
    counts = {r["_shard"]: r["n"] for r in placed.groupBy("_shard").agg(F.count("*").alias("n")).collect()}  # a row for each shard
    first, seen = [], 0
    for k in range(n_shards):
        first.append((k, seen))
        seen += counts.get(k, 0)
    starts = F.broadcast(spark.createDataFrame(first, "_shard int, _first long"))  # a row for each shard
    return placed.join(starts, "_shard").withColumn("_slot", F.col("_row0") + F.col("_pos") - F.col("_first"))


def _sized(docs: DataFrame, text: str) -> DataFrame:
    return docs.withColumn("_size", F.coalesce(F.octet_length(F.col(text)).cast("long") + OVERHEAD, F.lit(OVERHEAD).cast("long"))).withColumn("_crc", F.crc32(F.coalesce(F.col(text), F.lit(""))))


def _digest() -> list:
    return [F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), F.lit("bytes").alias("law"), F.col("_shard").alias("shard"), F.col("_slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard")]


def shards(docs: DataFrame, n_shards: int = 40, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Give each row of ``docs`` a shard by its place in a global order and the bytes before it.

    The order is (key with nulls first, CRC of the text, size); the key may be of any type that has an order. Rows are dealt
    into ranges of this order, with a last column that splits rows alike, so a key or row that makes a third of the table is
    spread over many ranges. Each range is sorted and summed by itself in one pass, and the totals of all ranges (one row each,
    bounded by the number of ranges) give every range its offset. A row whose middle byte is at x of a total of T bytes
    goes to shard floor(x * n / T), so each shard differs from T / n by less than its two border rows.

    Null text: no bytes, CRC of an empty text, size 16. Null keys come first. Equal keys are ordered by CRC and size, so
    repeated rows keep one total order up to rows that are alike. An empty table gives an empty result. Columns other than
    key and text are not read. A null or repeated key never drops a row. Equal texts with different keys (a group) keep
    their own places in the order: under this law a group isn't kept together, for it may be larger than a shard.
    """
    slim = stored(_sized(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("_text")), "_text").drop("_text"), "sizes")
    return _cut(slim, n_shards, ["doc_id", "_crc", "_size"]).select("doc_id", *_digest())


def sharded(docs: DataFrame, n_shards: int = 40, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with all their columns, and size, text_crc32, law, shard, slot and grown_shard as ``shards`` gives them;
    a column of ``docs`` with one of these names is kept under a name that begins with ``_own_``. Rows move once, into
    their ranges, so each stored part holds rows of neighbouring places. Nulls, repeats and empty tables as in ``shards``.
    """
    docs, _ = set_aside(docs, "size", "text_crc32", "law", "shard", "slot", "grown_shard", "_size", "_crc", "_any", "_range", "_pos", "_upto", "_row0", "_byte0", "_shard", "_first", "_slot")
    key, text = (next(c for c in docs.columns if c.lower() == k.lower()) for k in (key, text))
    return _cut(_sized(docs, text), n_shards, [key, "_crc", "_size"]).select(*docs.columns, *_digest())


def op3_sharding(spark, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of all documents: 40 shards by bytes."""
    return shards(load(spark, sf_dir, "documents"), 40)


#: CRC-32 byte by byte over the table of its 256 remainders, which SQL makes from the polynomial.
SQL = """
with recursive step(n, c, k) as (
  select i::ubigint, i::ubigint, 0 from range(256) t(i)
  union all select n, case when c & 1 = 1 then xor(3988292384::ubigint, c >> 1) else c >> 1 end, k + 1 from step where k < 8),
crc as (select list(c order by n) as tab from step where k = 8),
d as (select doc_id, coalesce(octet_length(encode(text)), 0) + 16 as size, hex(encode(coalesce(text, ''))) as hx from documents),
e as (select doc_id, size, xor(list_reduce(
        list_prepend(4294967295::ubigint, list_transform(range(1, length(hx), 2), lambda i: ((instr('0123456789ABCDEF', hx[i]) - 1) * 16 + instr('0123456789ABCDEF', hx[i + 1]) - 1)::ubigint)),
        lambda c, b: xor(tab[(xor(c, b) % 256)::bigint + 1], c >> 8)), 4294967295::ubigint)::bigint as text_crc32 from d, crc),
f as (select *, sum(size) over (order by doc_id nulls first, text_crc32, size rows unbounded preceding) as upto, sum(size) over () as whole from e),
g as (select *, least(39, floor_div) as shard from (select *, ((2 * upto - size) * 40 // (2 * whole))::int as floor_div from f))
select doc_id, size::bigint as size, text_crc32, 'bytes' as law, shard::int as shard,
  row_number() over (partition by shard order by doc_id nulls first, text_crc32, size) - 1 as slot, cast(null as int) as grown_shard from g
"""
