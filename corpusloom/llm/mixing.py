"""Mixing sources to target weights by pivotal dependent rounding (operator 10)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from corpusloom.llm.common import load, set_aside, stored, width

WEIGHTS = (1, 2, 3)
MOST = 3.0
GROUP = 4096
MOST_SOURCES, SALTS = 10_000, 64
WORD = r"[^\x20\x09-\x0D]+"
UNIT = "doc_id {id}, source string, size long, h long, n long, source_size long, target double, base long, mass double, cap double, u double"


def targets(totals: DataFrame, weights: tuple = WEIGHTS, most: float = MOST) -> DataFrame:
    """Add ``weight`` and ``target`` to (source, source_size), one row a source.

    Sources by code point, null last, get the weights in turn. Targets share the sum of all sizes by weight; a target stops at
    ``most`` times its source's size and the excess is shared again by weight. In closed form: with sources by
    most * size / weight, those below the water level stop at their cap and the rest share what is left. One row a source
    meets here, not one a document.
    """
    w = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(w) - 1, F.lit(len(weights))) + 1).cast("int"))
    t = totals.withColumn("weight", weight).withColumn("limit", F.lit(most) * F.col("source_size"))
    by = W.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    every = W.partitionBy()
    t = (t.withColumn("whole", F.sum("source_size").over(every).cast("double")).withColumn("weights", F.sum("weight").over(every))
         .withColumn("used", F.coalesce(F.sum("limit").over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
         .withColumn("past", F.coalesce(F.sum("weight").over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
         .withColumn("level", (F.col("whole") - F.col("used")) / (F.col("weights") - F.col("past"))))
    t = t.withColumn("place", F.row_number().over(by)).withColumn("dry", F.min(F.when(F.col("limit") > F.col("level") * F.col("weight"), F.col("place"))).over(every))
    t = t.withColumn("water", F.max(F.when(F.col("place") == F.col("dry"), F.col("level"))).over(every)).withColumn("capped", F.col("dry").isNull() | (F.col("place") < F.col("dry")))
    return t.select("source", "source_size", "weight", F.when(F.col("capped"), F.col("limit")).otherwise(F.col("water") * F.col("weight")).alias("target"))


def settled(row: list, mass: int, cap: int) -> list:
    """The last open unit of a source has no partner: its mass goes to the nearer end."""
    if 0 < row[mass] < row[cap]:
        row[mass] = row[cap] if 2 * row[mass] >= row[cap] else 0.0
    return row


def _pairing(last: bool):
    """Pivotal rounding of rows that come in runs of (bucket, source): one unit is carried, and each next one is paired with it.

    A pair moves mass from one to the other until one is empty or full; the direction is drawn so that no expectation changes
    and the sum of masses in words stays exactly. Per run one unit stays open (``open`` true), or is rounded if ``last``. Runs come with
    large units first, so that what stays open is small.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, key, kept = None, None, None
        for pdf in batches:
            names = list(pdf.columns)
            at = {c: i for i, c in enumerate(names)}
            bucket, source, mass, cap, draw = (at[c] for c in ("bucket", "source", "mass", "cap", "u"))
            out: list[list] = []

            def close(row: list, at_end: bool) -> None:
                if not at_end and 0 < row[mass] < row[cap]:
                    out.append([*row, True])
                    return
                out.append([*settled(row, mass, cap), False])

            for row in pdf.astype(object).where(pdf.notna(), None).values.tolist():
                if kept is None or (row[bucket], row[source]) != key:
                    if kept is not None:
                        close(kept, last)
                    key, kept = (row[bucket], row[source]), row
                    continue
                if not 0 < row[mass] < row[cap]:
                    out.append([*row, False])
                    continue
                if not 0 < kept[mass] < kept[cap]:
                    out.append([*kept, False])
                    kept = row
                    continue
                up, down = min(kept[cap] - kept[mass], row[mass]), min(kept[mass], row[cap] - row[mass])
                both = kept[mass] + row[mass]
                if row[draw] * (up + down) < down:  # mass goes from the row to the carried one
                    if both <= kept[cap]:
                        kept[mass], row[mass] = both, 0.0
                    else:
                        kept[mass], row[mass] = kept[cap], both - kept[cap]
                elif both <= row[cap]:
                    kept[mass], row[mass] = 0.0, both
                else:
                    kept[mass], row[mass] = both - row[cap], row[cap]
                if 0 < kept[mass] < kept[cap]:
                    out.append([*row, False])
                else:
                    out.append([*kept, False])
                    kept = row
            yield pd.DataFrame(out, columns=[*names, "open"])
        if kept is not None:
            mass, cap = names.index("mass"), names.index("cap")
            inner = 0 < kept[mass] < kept[cap] and not last
            yield pd.DataFrame([[*(kept if inner else settled(kept, mass, cap)), inner]], columns=[*names, "open"])

    return run


def copies(docs: DataFrame, weights: tuple = WEIGHTS, most: float = MOST, group: int = GROUP, seed: int = 7) -> DataFrame:
    """One row for each distinct (doc_id, source, text): doc_id, source, size, h (of the text), n (equal rows), source_size,
    target, copies.

    Each unit is to be copied target / source_size times: the whole part is certain, the rest is a mass in words that
    pivotal pairing turns into none or one more copy. Units are dealt into groups of about ``group`` by a hash of their
    id, so a source with a third of all rows is spread over all groups; each group pairs a source's units in one
    streaming pass and leaves at most one open unit. The open units are dealt again into fewer groups, until one pass
    rounds the last one of each source. Every level is stored. The words taken from a source differ from its target by at most
    half of one of its units. Draws come from hashes of the id and ``seed``: reruns agree.

    Null text: size 0, nothing is taken. A null source is a source of its own, the last one. Null and repeated ids are
    kept; rows alike in id, source and text are one unit of n rows, which share the number of copies. Empty: empty. Other columns of
    ``docs``, whatever their names, aren't read here; ``mixed`` keeps them. Texts of any length are counted by one expression.
    """
    slim = stored(docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.xxhash64("text").alias("h")), "sizes")
    units = slim.groupBy("doc_id", "source", "size", "h").agg(F.count("*").alias("n"))
    totals = targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    totals = stored(totals.select(F.col("source").alias("s"), "source_size", "target"), "targets")
    rows = slim.count()
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(ratio + F.lit(1e-12))
    if totals.count() <= MOST_SOURCES:  # counted: at most 10,000 short rows are broadcast
        joined = units.join(F.broadcast(totals), units.source.eqNullSafe(totals.s), "left")
    else:  # a source with a third of all rows is dealt over salts
        spread = totals.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = units.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "h"), F.lit(SALTS)).cast("int"))
        joined = salted.join(spread, F.col("source").eqNullSafe(F.col("s")) & (F.col("_salt") == F.col("_part")), "left")
    now = joined.select(
        "doc_id", "source", "size", "h", "n", "source_size", "target", whole.cast("long").alias("base"),
        (F.greatest(ratio - whole, F.lit(0.0)) * F.col("size") * F.col("n")).alias("mass"), (F.col("size") * F.col("n")).cast("double").alias("cap"),
        ((F.xxhash64("doc_id", "source", "h", F.lit(seed)).bitwiseAND(F.lit((1 << 52) - 1))) / F.lit(float(1 << 52))).alias("u"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    groups, level, done = max(1, -(-rows // group)), 0, []
    while True:
        last = groups == 1
        dealt = now.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "h", F.lit(seed + 1 + level)), F.lit(groups)).cast("int"))
        dealt = dealt.repartition(min(groups, width(docs.sparkSession)), "bucket").sortWithinPartitions("bucket", "source", F.desc("cap"), "doc_id", "h")
        out = stored(dealt.mapInPandas(_pairing(last), UNIT.format(id=id_type) + ", bucket int, open boolean"), f"level{level}")
        done.append(out.where("not open") if not last else out)
        if last:
            break
        now = out.where("open").drop("bucket", "open")
        left = now.count()
        groups = min(groups - 1, max(1, -(-left // group)))
        level += 1
    every = done[0]
    for d in done[1:]:
        every = every.unionAll(d)
    return every.select("doc_id", "source", "size", "h", "n", "source_size", "target", (F.col("base") + F.when((F.col("cap") > 0) & (F.col("mass") >= F.col("cap")), 1).otherwise(0)).alias("copies"))


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: each row of ``docs``, with all its columns, as often as ``copies`` says."""
    plan = copies(docs, **how)
    plan = plan.select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("h").alias("_h"), "copies").where("copies > 0")
    docs, names = set_aside(docs, "_id", "_source", "_h", "_text_h", "copies", "_copy")
    keyed = docs.withColumn("_text_h", F.xxhash64("text"))
    out = keyed.join(plan, keyed.doc_id.eqNullSafe(plan._id) & keyed.source.eqNullSafe(plan._source) & (keyed._text_h == plan._h))
    return out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*names)


def op10_mixing(spark, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target and taken words of every document."""
    plan = copies(load(spark, sf_dir, "documents"))
    plan = plan.withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
