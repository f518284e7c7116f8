"""Near-duplicate vectors through a pivot-permutation index (operator 4)."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.common import connected_components, load, stored
from corpusloom.llm.simhash import forest

LEAST = 0.95
NEAREST = 10
RADII = (1, 1.5, 2, 3, 4)
LIST = 256
BLOCK_BYTES, TILE = 4_000_000, 1024
MOST_PIVOTS, MOST_NUMBERS = 16384, 4_000_000


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows, of ``dim`` columns; shorter ones are filled up with zeros (lengths are compared apart)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat, size = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), column.value_lengths().to_numpy()
    if (size == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(size), dim))
    at = np.repeat(np.arange(len(size)), size), np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    out[at] = flat
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # first by the largest component: no square is too large or too small
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _carved(sample: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """(places of pivots in ``sample``, radius of each): balls that together cover the sample, so a dense group has few pivots.

    Each vector that no ball holds yet becomes a pivot. Of ``RADII`` (times the angle of a link) it takes the one with the
    fewest comparisons for a newly covered vector, where all within radius and one link's angle more meet.
    """
    step = np.arccos(least)
    radii = np.minimum(np.array(RADII) * step, np.pi)
    inner, outer = np.cos(radii), np.cos(np.minimum(radii + step, np.pi))
    x = sample.astype(np.float32)
    free, places, chosen = np.ones(len(x), bool), [], []
    for at in range(0, len(x), 64):
        some = at + np.flatnonzero(free[at : at + 64])
        if not len(some):
            continue
        for p, near in zip(some, x[some] @ x.T):
            if not free[p]:
                continue
            near[p] = 1
            cost = [float((near >= o).sum()) ** 2 / (free & (near >= i)).sum() for i, o in zip(inner, outer)]
            best = int(np.argmin(cost))
            free &= near < inner[best]
            free[p] = False
            places.append(p)
            chosen.append(radii[best])
    return np.array(places, np.int64), np.array(chosen)


def _describing(pivots, dim: int, nearest: int, least: float):
    """Add ``perm``: the pivots under which each vector is listed.

    These are all pivots within their radius and one link's angle more, and, for a vector in no pivot's ball, its nearest
    ones. By the triangle inequality all links of a vector inside a ball are then in that pivot's list.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, radius = pivots.value
        k = min(nearest, len(table))
        slack = 1e-5  # more than the error of a product in single precision: lists may hold more than they need, never less
        inner, outer = (np.cos(radius) + slack).astype(np.float32), (np.cos(np.minimum(radius + np.arccos(least), np.pi)) - slack).astype(np.float32)
        for batch in batches:
            if not batch.num_rows:
                continue
            perm, size = [], []
            for at in range(0, batch.num_rows, 1024):
                near = _unit(_matrix(batch.slice(at, 1024).column(2), dim)).astype(np.float32) @ table.T
                listed = near >= outer
                alone = np.flatnonzero(~(near >= inner).any(axis=1))
                listed[alone[:, None], np.argpartition(-near[alone], k - 1, axis=1)[:, :k]] = True
                perm.append(np.nonzero(listed)[1].astype(np.int32))
                size.append(listed.sum(axis=1))
            ends = np.concatenate([[0], np.cumsum(np.concatenate(size))])
            column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(perm)))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "perm"])

    return run


def _pairs(dim: int, least: float):
    """All links between the two sides of a pair of blocks of one pivot's list.

    The cosines of all pairs are computed in double precision. A pair that meets in several lists counts in that of its
    smallest shared pivot. Returns links as counts by vector and as a spanning forest, never as all pairs.
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        pivot, same = key[0].as_py(), key[1].as_py() == key[2].as_py()
        table = table.combine_chunks()
        rid, n, side = (table[c].to_numpy() for c in ("rid", "n", "side"))
        x, size = _unit(_matrix(table["vec"], dim)), table["vec"].combine_chunks().value_lengths().to_numpy()
        lists = table["perm"].combine_chunks()
        row, flat = np.repeat(np.arange(len(rid)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()
        row, flat = row[flat < pivot], flat[flat < pivot]
        one = np.flatnonzero(side == 0)
        two = one if same else np.flatnonzero(side == 1)
        count, a, b = np.zeros(len(rid), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for p in range(0, len(one), TILE):
            for q in range(p if same else 0, len(two), TILE):
                u, v = one[p : p + TILE], two[q : q + TILE]
                met = x[u] @ x[v].T >= least
                if same and p == q:
                    met = np.triu(met, 1)
                if not met.any():
                    continue
                met &= size[u][:, None] == size[v][None, :]
                i, j = np.flatnonzero(met.any(axis=1)), np.flatnonzero(met.any(axis=0))
                met[np.ix_(i, j)] &= _apart(row, flat, len(rid), u[i], v[j])  # not those that share a smaller pivot
                i, j = np.nonzero(met)
                i, j = u[i], v[j]
                count += np.bincount(i, n[j], len(rid)).astype(np.int64) + np.bincount(j, n[i], len(rid)).astype(np.int64)
                a, b = forest(np.concatenate([a, rid[i]]), np.concatenate([b, rid[j]]))
        some = np.flatnonzero(count)
        return pa.table({
            "a": pa.array(np.concatenate([rid[some], a]), pa.int64()),
            "b": pa.array([*[None] * len(some), *b.tolist()], pa.int64()),
            "links": pa.array(np.concatenate([count[some], np.zeros(len(a), np.int64)]), pa.int64())})

    return run


def _apart(row: np.ndarray, flat: np.ndarray, n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """For each of ``u`` and each of ``v``: do their lists, as (row, pivot) pairs, share no pivot? Shared pivots are counted by the
    inverted lists as one product."""
    want = np.zeros(n, bool)
    want[u] = want[v] = True
    own = want[row]
    near, local = np.unique(flat[own], return_inverse=True)
    place = np.full(n, -1)
    both = np.unique(np.concatenate([u, v]))
    place[both] = np.arange(len(both))
    member = np.zeros((len(both), len(near)), np.float32)
    member[place[row[own]], local] = 1
    return member[place[u]] @ member[place[v]].T == 0


def near_vectors(rows: DataFrame, least: float = LEAST, nearest: int = NEAREST) -> DataFrame:
    """vec_id, n_links, component_id, kept and embedding of each row of ``rows(vec_id, embedding)``.

    Equal vectors collapse first (map-side combine) and count with their number. A bounded sample of distinct vectors serves as
    pivots (1 for about 25 vectors, growing with the square root of their number beyond 20,000 of them, 16,384 or 4 million numbers at most, taken by hash), less those inside the ball of another, so a
    dense group has few. A vector inside a ball is listed under each pivot that one of its links can have, and all its links are
    found; one in no ball is listed under its 10 nearest pivots too, and two such vectors link if they share a list. Lists are cut into blocks
    of 4 MB of numbers by hash, and each pair of blocks is a task's group, so no list meets in one task. Components are found by distributed
    rounds. Beyond 16,384 pivots lists grow with the table, and with them the work for a vector and, by one block of 4 MB at a time, how
    often it is sent.

    A vector that is null, zero, empty, or holds null or non-finite components links with nothing; vectors of different
    lengths don't link. Null ids: such a row takes part, counts as a link, and names no component unless all its ids are null.
    Repeated rows link with each other. Empty in, empty out.
    """
    spark = rows.sparkSession
    fine = F.coalesce(F.col("embedding").isNotNull() & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("embedding", lambda v: v != 0), F.lit(False))
    rows = rows.select("vec_id", "embedding", fine.alias("fine"))
    reps = rows.where("fine").groupBy("embedding").agg(F.count("*").alias("n"), F.min("vec_id").alias("vec_id"))
    reps = stored(reps.select(F.monotonically_increasing_id().alias("rid"), "n", F.col("embedding").alias("vec"), "vec_id"), "vectors")
    have = reps.agg(F.count("*").alias("n"), F.max(F.size("vec")).alias("dim")).first()
    if have["n"]:
        want = int(min(MOST_PIVOTS, max(64, MOST_NUMBERS // have["dim"]), max(nearest, -(-have["n"] * nearest // max(LIST, math.isqrt(3 * have["n"]))))))
        odds = min(1.0, 2.0 * want / have["n"] + 50 / have["n"])
        picked = reps.where(F.pmod(F.xxhash64("vec"), F.lit(1 << 30)) <= int(odds * (1 << 30))).select(F.xxhash64("vec").alias("h"), "vec").orderBy("h").limit(want)
        chosen = [r["vec"] for r in picked.collect()]  # at most MOST_PIVOTS
        table = np.zeros((len(chosen), have["dim"]))
        for i, v in enumerate(chosen):
            table[i, : len(v)] = v
        table = _unit(table)
        places, radius = _carved(table, least)
        pivots = spark.sparkContext.broadcast((table[places].astype(np.float32), radius))
        kind = reps.schema["vec"].dataType.simpleString()
        marked = stored(reps.select("rid", "n", "vec").mapInArrow(_describing(pivots, have["dim"], nearest, least), f"rid long, n long, vec {kind}, perm array<int>"), "described")
        lists = marked.select("rid", "n", "vec", "perm", F.explode("perm").alias("pivot"))
        sizes = marked.select(F.explode("perm").alias("pivot")).groupBy("pivot").agg(F.ceil(F.count("*") / max(TILE, BLOCK_BYTES // (8 * have["dim"]))).cast("int").alias("blocks"))
        lists = lists.join(F.broadcast(sizes), "pivot").withColumn("own", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))  # one row a pivot, 16,384 at most
        pairs = lists.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
            "pivot", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), "rid", "n", "vec", "perm", F.when(F.col("own") <= F.col("o"), 0).otherwise(1).alias("side"))
        found = stored(pairs.groupBy("pivot", "i", "j").applyInArrow(_pairs(have["dim"], least), "a long, b long, links long"), "found")
    else:
        found = spark.createDataFrame([], "a long, b long, links long")
    links = found.where("b is null").groupBy(F.col("a").alias("rid")).agg(F.sum("links").alias("links"))
    roots = connected_components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "rid")
    named = reps.join(links, "rid", "left").join(roots, "rid", "left").select("vec", "vec_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "rid").alias("root"))
    name = named.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    known = named.select("vec", "n_links", "root").join(name, "root").select("vec", "n_links", "component_id")
    out = rows.join(known, F.col("fine") & (rows.embedding == known.vec), "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"), F.coalesce("component_id", "vec_id").eqNullSafe(F.col("vec_id")).alias("kept"), "embedding")


def op4_embeddings(spark, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    return near_vectors(load(spark, sf_dir, "embeddings").select("vec_id", "embedding")).drop("embedding")
