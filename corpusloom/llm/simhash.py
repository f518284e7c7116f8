"""SimHash near-duplicates through deletion-variant signatures (operator 8)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.arrow import rows_of
from corpusloom.llm.common import connected_components, load, set_aside, stored, width
from corpusloom.llm.xxh import xxh64

SHINGLE = 4
MOST_BITS = 4
SEED = 42
BUCKET = 4096
PIECE = 1 << 20
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
#: The bits of a byte as eight bytes of a number.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").copy().view(np.uint64)[:, 0]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _compact(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(A-Z lower-cased words with one space behind each, where each begins and ends, its row) of texts side by side."""
    apart = np.insert(_LOW[data], offsets[1:], np.uint8(32))  # a space behind each text
    into = ~_SPACE[apart]
    before = np.empty(len(into), bool)
    before[:1] = False
    before[1:] = into[:-1]
    row = np.searchsorted(offsets[1:] + np.arange(len(offsets) - 1), np.flatnonzero(into & ~before))
    keep = into | before
    c, into = apart[keep], into[keep]
    c[~into] = 32
    ends = np.flatnonzero(~into)
    return c, np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends, ends, row


def _votes(offsets: np.ndarray, data: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(for each text the number of its shingles with each bit set, the number of its shingles)."""
    n = len(offsets) - 1
    c, s, e, row = _compact(offsets, data)
    per = np.bincount(row, minlength=n)
    first = np.cumsum(per) - per
    many = np.maximum(per - shingle + 1, np.minimum(per, 1))
    own = np.repeat(np.arange(n), many)
    at = first[own] + np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many)
    last = np.minimum(at + shingle, (first + per)[own]) - 1
    h = xxh64(c, s[at], e[last] - s[at], SEED) if len(at) else np.zeros(0, np.uint64)
    votes = np.zeros((n, 64), np.int64)
    if len(h):  # eight counters a number, in runs so short that none overflows
        turns = -(-many // 255)
        owner = np.repeat(np.arange(n), turns)
        begin = (np.cumsum(many) - many)[owner] + 255 * (np.arange(len(owner)) - np.repeat(np.cumsum(turns) - turns, turns))
        runs = np.add.reduceat(_LANES[h.view(np.uint8)].reshape(-1, 8), begin, axis=0).view(np.uint8).reshape(-1, 64)
        some = np.flatnonzero(turns)
        votes[some] = np.add.reduceat(runs.astype(np.int64), (np.cumsum(turns) - turns)[some], axis=0)
    return votes, many


def _voted(votes: np.ndarray, many: np.ndarray) -> np.ndarray:
    return np.packbits(2 * votes > many[:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]


def _long(data: np.ndarray, shingle: int, piece: int) -> int:
    """The fingerprint of one long text in pieces that end between words; the last words of a piece go before the next one."""
    votes, many, carry, at = np.zeros((1, 64), np.int64), np.zeros(1, np.int64), np.zeros(0, np.uint8), 0
    while at < len(data):
        end = min(at + piece, len(data))
        while end < len(data) and not _SPACE[data[end]]:
            end += 1
        text = np.concatenate([carry, data[at:end]])
        c, s, e, _ = _compact(np.array([0, len(text)], np.int64), text)
        at = end
        if len(s) >= shingle or at == len(data) and (len(s) or many[0]):
            if len(s) >= shingle or not many[0]:
                v, m = _votes(np.array([0, len(c)], np.int64), c, shingle)
                votes, many = votes + v, many + m
            c = c[s[len(s) - shingle + 1] :] if shingle > 1 else c[:0]
        carry = c
    return int(_voted(votes, many)[0])


def fingerprint(text: bytes, shingle: int = SHINGLE, piece: int = PIECE) -> int:
    """The 64-bit SimHash of a text: words at white space, A-Z lower-cased, all shingles with repeats, XXH64 votes for each bit."""
    data = np.frombuffer(text, np.uint8)
    if len(data) > 2 * piece:
        return _long(data, shingle, piece)
    return int(_voted(*_votes(np.array([0, len(data)], np.int64), data, shingle))[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("text")
        for part, off, data in rows_of(batch, PIECE):
            if len(data) > 2 * PIECE:  # one long text
                found = np.array([_long(data, SHINGLE, PIECE)], np.uint64)
            else:
                found = _voted(*_votes(off, data, SHINGLE))
            rest = [i for i in range(part.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([*(part.column(i) for i in rest), pa.array(found.view(np.int64))], [*(part.schema.names[i] for i in rest), "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` with ``fp`` (the fingerprint as a signed long) in place of text."""
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name not in ("text", "fp"))
    return docs.drop("fp").mapInArrow(_fingerprints, f"{kept}, fp long")


def segments(most: int = MOST_BITS) -> list[tuple[int, int]]:
    """(first bit, bits) of so few segments that of two words with ``most`` differing bits, one segment differs in one bit at most."""
    n = most // 2 + 1
    cuts = [round(64 * i / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def variants(fps: DataFrame, most: int = MOST_BITS) -> DataFrame:
    """(key, fp): for each segment its value, and its value with each one bit deleted. The place of the deleted bit is part of the key."""
    keys = []
    for k, (at, bits) in enumerate(segments(most)):
        value = F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << bits) - 1)) if bits < 64 else F.col("fp")
        keys.append(value.bitwiseOR(F.lit((k * 65 + 64) << 48)))
        for j in range(bits):
            without = value.bitwiseAND(F.lit(((1 << bits) - 1) & ~(1 << j)))
            keys.append(without.bitwiseOR(F.lit((k * 65 + j) << 48)))
    return fps.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _bit(keys: np.ndarray, most: int) -> np.ndarray:
    """For each key the mask of its deleted bit in the fingerprint; 0 for a whole segment."""
    code = (keys >> 48).astype(np.int64)
    first = np.array([a for a, _ in segments(most)], np.int64)[code // 65]
    mask = np.left_shift(np.uint64(1), (first + code % 65).astype(np.uint64) % np.uint64(64))
    return np.where(code % 65 == 64, np.uint64(0), mask)


def _near(x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
    return np.bitwise_count(x ^ y) <= most


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest, each node to the smallest of its tree."""
    if not len(a):
        return a, b
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[u], root[v])
        new = root.copy()
        np.minimum.at(new, root[u], low)
        np.minimum.at(new, root[v], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    own = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[own], nodes[root[own]]


def links_of_runs(keys: np.ndarray, fps: np.ndarray, most: int = MOST_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal keys, as forests. In a wildcard run only fingerprints that differ in the deleted bit are
    compared: those that agree there agree in the whole segment and meet under its own key."""
    x, bit = fps.view(np.uint64), _bit(keys, most)
    at, step, left, right = np.arange(len(keys) - 1), 1, [], []
    a = b = np.zeros(0, np.int64)
    while len(at):
        at = at[at + step < len(keys)]
        at = at[keys[at] == keys[at + step]]
        other = x[at] ^ x[at + step]
        hit = at[(np.bitwise_count(other) <= most) & ((bit[at] == 0) | (other & bit[at] != 0))]
        left.append(fps[hit])
        right.append(fps[hit + step])
        if sum(map(len, left)) > 1_000_000:
            a, b = forest(np.concatenate([a, *left]), np.concatenate([b, *right]))
            left, right = [], []
        step += 1
    return forest(np.concatenate([a, *left]), np.concatenate([b, *right]))


_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("key", pa.int64())])


def _edges(a, b, key=None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(key, pa.int64()) if key is not None else pa.nulls(len(a), pa.int64())], schema=_EDGE)


def _linking(most: int, limit: int):
    """Rows (key, fp) come by key. Links of runs up to ``limit`` go out as (a, b, null); the rows of longer ones as (fp, fp, key)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps, over = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy()])
            begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            last = int(begins[-1])  # the last run may go on in the next batch
            yield from whole(keys[:last], fps[:last], over)
            if last:
                over = None
            keys, fps = keys[last:], fps[last:]
            if len(keys) > limit:
                over = keys[0]
                yield _edges(fps, fps, keys)
                keys, fps = keys[:0], fps[:0]
            elif over is not None and len(keys) and keys[0] != over:
                over = None
        if len(keys):
            yield from whole(keys, fps, over)

    def whole(keys, fps, over) -> Iterator[pa.RecordBatch]:
        if not len(keys):
            return
        begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        size = np.diff(np.append(begins, len(keys)))
        big = np.repeat((size > limit) | (keys[begins] == (over if over is not None else -1)), size)
        if big.any():
            yield _edges(fps[big], fps[big], keys[big])
        single = np.repeat(size == 1, size)
        a, b = links_of_runs(keys[~big & ~single], fps[~big & ~single], most)
        if len(a):
            yield _edges(a, b)

    return run


def _block_pair(most: int):
    """One pair of blocks of a long run: all rows of one (key, i, j), as two sides of at most a block each."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        fp, side = table["fp"].to_numpy(), table["side"].to_numpy()
        one, two = np.unique(fp[side == 0]), np.unique(fp[side == 1])
        two = one if key[1].as_py() == key[2].as_py() else two
        bit = _bit(np.array([key[0].as_py()], np.int64), most)[0]
        a = b = np.zeros(0, np.int64)
        for at in range(0, len(one), 256):
            other = one[at : at + 256, None].view(np.uint64) ^ two[None, :].view(np.uint64)
            i, j = np.nonzero((np.bitwise_count(other) <= most) & ((bit == 0) | (other & bit != 0)))
            a, b = forest(np.concatenate([a, one[at + i]]), np.concatenate([b, two[j]]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def links(fps: DataFrame, most: int = MOST_BITS, limit: int = BUCKET) -> DataFrame:
    """Edges (a, b) that join what ``fps`` links at ``most`` differing bits: not all pairs, but enough for the same classes.

    ``fps`` holds distinct fingerprints. Each is indexed under 3 segments and 64 one-wildcard variants; equal keys meet,
    are verified, and leave a spanning forest. A run of more than ``limit`` under a key is cut into blocks, and each pair
    of blocks is a task of its own.
    """
    spark = fps.sparkSession
    met = variants(fps, most).repartition(max(width(spark), 1), "key").sortWithinPartitions("key")
    found = stored(met.mapInArrow(_linking(most, limit), "a long, b long, key long"), "links")
    edges = found.where("key is null").select("a", "b")
    long = found.where("key is not null").select("key", F.col("a").alias("fp"))
    sizes = long.groupBy("key").agg(F.count("*").alias("n"))
    if sizes.isEmpty():
        return edges
    long = long.join(sizes, "key").withColumn("blocks", F.ceil(F.col("n") / limit).cast("int")).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    pairs = long.select("key", "fp", "own", F.explode(other).alias("o")).select(
        "key", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), "fp", F.when(F.col("own") <= F.col("o"), 0).otherwise(1).alias("side"))
    return edges.unionAll(pairs.groupBy("key", "i", "j").applyInArrow(_block_pair(most), "a long, b long"))


def classes(docs: DataFrame, most: int = MOST_BITS) -> DataFrame:
    """``docs`` (with doc_id and text) without text, with fp, class_fp (the class by its smallest fingerprint) and component_id.

    Copies collapse into one fingerprint with map-side combine before anything is compared. Null and wordless texts have the
    fingerprint 0 and are linked like others; a null doc_id takes part but gives no component its name, unless all ids of a
    component are null. Repeated ids keep a row each. Columns fp, class_fp and component_id of ``docs`` are replaced, others stay.
    Texts are hashed in pieces of about 1 MB, a longer one in several. Empty in, empty out.
    """
    marked = stored(fingerprints(docs.drop("class_fp", "component_id")), "fingerprints")
    nodes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "nodes")
    roots = connected_components(links(nodes.select("fp"), most))
    named = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "doc_id", F.coalesce("root", "fp").alias("root"))
    name = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    known = named.select("fp", "root").join(name, "root").select(F.col("fp").alias("_fp"), F.col("root").alias("class_fp"), "component_id")
    return marked.join(known, marked.fp == known._fp).drop("_fp")


def op8_simhash(spark, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (16 lowercase hex digits) and component_id of every document."""
    found = classes(load(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicated(docs: DataFrame, most: int = MOST_BITS) -> DataFrame:
    """``docs`` with one row of each class: that with the smallest doc_id (of repeated rows with that id, one for each text).

    Rows alike in doc_id and text are reduced to one before they are shuffled, in each task and then by key, so an id or a text that
    makes a third of all rows is no task of its own. All columns stay, whatever their names; of rows alike in doc_id and text
    any one gives them. Nulls as in ``classes``; whole texts are read, long ones in pieces. Empty in, empty out.
    """
    docs, names = set_aside(docs, "_h", "h", "_id", "_key", "class_fp", "component_id", "fp")
    id_of = F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit(""))  # null is no id's text
    once = docs.withColumn("_key", id_of).withColumn("_h", F.xxhash64("text")).dropDuplicates(["_key", "_h"])
    kept = classes(docs.select("doc_id", "text", F.xxhash64("text").alias("h")), most)
    kept = kept.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy(id_of.alias("_key"), "class_fp").agg(F.min("h").alias("_h")).select("_key", "_h").distinct()
    return once.join(kept, ["_key", "_h"]).select(*names)
