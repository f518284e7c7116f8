"""Differences between two versions, inventories and listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def keyed_difference(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Keys in one version alone: side ``missing`` (only in old) or ``extra`` (only in new), as sets (ST1, ST2, AG10)."""
    a, b = (d.select(*[F.coalesce(k, F.lit("")).alias(k) for k in keys]) for d in (old, new))
    both = a.withColumn("_o", F.lit(1)).withColumn("_n", F.lit(0)).unionAll(b.withColumn("_o", F.lit(0)).withColumn("_n", F.lit(1)))
    met = both.groupBy(*keys).agg(F.max("_o").alias("_o"), F.max("_n").alias("_n")).where("_o <> _n")  # one shuffle for both ways
    return met.select(*keys, F.when(F.col("_o") == 1, "missing").otherwise("extra").alias("side"))


def inventory_diff(local: DataFrame, remote: DataFrame, key: list[str], size: str = "bytes") -> DataFrame:
    """What to do with each name: NEW, UPDATE, CURRENT or ORPHAN (JN20)."""
    a = local.select(*key, F.col(size).alias("local_size")).withColumn("_l", F.lit(True))
    b = remote.select(*key, F.col(size).alias("remote_size")).withColumn("_r", F.lit(True))
    met = a.join(b, key, "full_outer")
    action = F.when(F.col("_r").isNull(), "NEW").when(F.col("_l").isNull(), "ORPHAN").when(F.col("local_size") == F.col("remote_size"), "CURRENT").otherwise("UPDATE")
    return met.select(*key, "local_size", "remote_size", action.alias("action"))


def plan_counts(plan: DataFrame) -> DataFrame:
    return plan.groupBy("action").agg(F.count("*").alias("n"))  # AG18


def plan_listing(plan: DataFrame, key: str, most: int | None = 10) -> DataFrame:
    """The first names of each action, as a report lists them, and how many more there are (SO11)."""
    w = W.partitionBy("action")
    out = plan.withColumn("place", F.row_number().over(w.orderBy(key))).withColumn("more", F.greatest(F.count("*").over(w) - (most or 0), F.lit(0)).cast("bigint") if most else F.lit(0).cast("bigint"))
    return out.where(F.col("place") <= most) if most else out


def moved_and_missing(a: DataFrame, b: DataFrame, group: str, title: str, order: str) -> DataFrame:
    """For each (group, title) of ``a`` that ``b`` lacks: the group of the first row of ``b`` with that title, or null (JN16, JN17).

    An equi-join on the title after one aggregation of ``b`` by title: no scan of all of ``b`` for each row."""
    only = a.join(b.select(group, title), [group, title], "left_anti")
    to = b.groupBy(title).agg(F.min_by(group, F.struct(order, group)).alias("moved_to"))
    return only.join(to, title, "left").select(*a.columns, "moved_to", F.when(F.col("moved_to").isNull(), "missing").otherwise("moved").alias("status"))


def moved_within(df: DataFrame, listing: str, group: str, title: str, order: str) -> DataFrame:
    """As ``moved_and_missing`` for two listings in one table (``listing`` 0 against 1). Titles are aggregated once for both
    listings, by title and group and then by title, and rows of the first listing meet the result by equality."""
    second = F.min(F.when(F.col(listing) == 1, F.col(order)))
    pairs = df.groupBy(title, group).agg(second.alias("_second"), F.max(F.col(listing) == 0).alias("_first"))
    there = F.col("_second").isNotNull()
    to = F.min_by(F.when(there, F.col(group)), F.when(there, F.struct("_second", group))).over(W.partitionBy(title))
    only = pairs.withColumn("moved_to", to).where("_first and _second is null").select(title, group, "moved_to")
    rows = df.where(F.col(listing) == 0).drop(listing).join(only, [title, group])
    return rows.withColumn("status", F.when(F.col("moved_to").isNull(), "missing").otherwise("moved"))


def absent(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Rows whose key the other table lacks (JN8, JN9, JN19)."""
    return df.join(known.select(key).distinct(), key, "left_anti")


def overlap_counts(df: DataFrame, key: str, author: str, origin: str, long_enough: Column) -> DataFrame:
    """Groups over several origins and the rows beyond the first of each, by name alone (AG11) and by name and author for titles
    that are long enough (AG12, FI20) where no row has a file name: one scan, one shuffle by key.
    """
    one = df.withColumn("_long", long_enough).groupBy(key, author, origin, "_long").agg(F.count("*").alias("n"))
    both = one.groupBy(key, author, "_long").agg(F.sum("n").alias("n"), F.collect_set(origin).alias("_o"))
    titles = F.struct(F.sum(F.when(F.col("_long") & (F.size("_o") > 1), 1)).alias("groups"), F.sum(F.when(F.col("_long") & (F.size("_o") > 1), F.col("n") - 1)).alias("removable"))
    keys = both.groupBy(key).agg(F.sum("n").alias("n"), F.array_distinct(F.flatten(F.collect_list("_o"))).alias("_o"), titles.alias("t"))
    many = F.size("_o") > 1
    sums = keys.agg(F.count_if(many).alias("g1"), F.coalesce(F.sum(F.when(many, F.col("n") - 1)), F.lit(0)).alias("r1"), F.coalesce(F.sum("t.groups"), F.lit(0)).alias("g2"), F.coalesce(F.sum("t.removable"), F.lit(0)).alias("r2"))
    return sums.select(F.explode(F.array(F.struct(F.lit("name").alias("kind"), F.col("g1").alias("groups"), F.col("r1").alias("removable")), F.struct(F.lit("title").alias("kind"), F.col("g2").alias("groups"), F.col("r2").alias("removable")))).alias("x")).select("x.*")


def gap_listing(moved: DataFrame, group: str, title: str) -> DataFrame:
    """The rows of ``moved_and_missing`` as a report lists them: moved ones by title, then missing ones by group, as one range
    sort (SO12)."""
    at = F.when(F.col("status") == "moved", F.col(title)).otherwise(F.col(group))
    return moved.orderBy(F.desc("status"), at, title, group)


def titles_by_group(df: DataFrame, group: str, title: str) -> DataFrame:
    """The sorted titles of each group as one array (AG13), for the listing of a group that one cell can hold."""
    return df.groupBy(group).agg(F.sort_array(F.collect_list(title)).alias("titles"))


def titles_in_order(df: DataFrame, group: str, title: str) -> DataFrame:
    """The same as rows: groups in order, titles in order within each, one range sort and no array however large a group is (AG13)."""
    return df.select(group, title).orderBy(group, title)


def shared_members(df: DataFrame, key: str, member: str) -> DataFrame:
    """(key, n, member) for each distinct member of a key that more than one member has (AG6). Keys are counted first, with
    map-side combine, and only rows of shared keys go on: no key's members meet in one array."""
    pairs = df.where(F.coalesce(F.col(key), F.lit("")) != "").select(key, member).distinct()
    many = pairs.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    return pairs.join(many, key).select(key, "n", member)


def shared_keys(df: DataFrame, key: str, member: str, name: str = "members") -> DataFrame:
    """Keys that more than one member has, with the members sorted (AG6, CK12), as a report prints them; ``shared_members``
    gives them as rows."""
    return shared_members(df, key, member).groupBy(key, "n").agg(F.sort_array(F.collect_list(member)).alias(name))


def cross_origin(df: DataFrame, key: str, origin: str) -> DataFrame:
    """Keys that span several origins, and the rows beyond the first (AG11)."""
    return df.where(F.col(key) != "").groupBy(key).agg(F.count("*").alias("n"), F.count_distinct(origin).alias("origins")).where("origins > 1").withColumn("removable", F.col("n") - 1)


def title_overlaps(df: DataFrame, title: str, author: str, name: str, origin: str, shortest: int = 15) -> DataFrame:
    """Groups of equal title and author over several origins, but for short titles and for groups whose named rows all share
    their file name with another row (AG12, FI20)."""
    names = df.where(F.col(name) != "").groupBy(name).agg((F.count("*") > 1).alias("_dup"))
    rows = df.join(names, name, "left")
    caught = F.bool_and(F.when(F.col(name) != "", F.coalesce("_dup", F.lit(False))))
    out = rows.where(F.length(title) >= shortest).groupBy(title, author).agg(F.count("*").alias("n"), F.count_distinct(origin).alias("origins"), F.coalesce(caught, F.lit(True)).alias("caught"))
    return out.where("origins > 1 and not caught").select(title, author, "n", (F.col("n") - 1).alias("removable"))
