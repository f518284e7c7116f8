"""Benchmark decontamination: a broadcast hash set of test n-grams against all word windows of the training texts (operator 2)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.arrow import rows_of
from corpusloom.llm.common import load, stored

WINDOW = 10
BENCH_MB = 16
PIECE = SPAN = 1 << 20
LONG = 4
_LOW = np.zeros(256, np.uint8)
for _b in range(256):
    if 48 <= _b <= 57 or 97 <= _b <= 122 or _b >= 128:
        _LOW[_b] = _b
    elif 65 <= _b <= 90:
        _LOW[_b] = _b + 32
_BASE, _STEP = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_POWERS = np.ones(1, np.uint64)
_INVERSE = np.ones(1, np.uint64)


def _powers(n: int) -> None:
    global _POWERS, _INVERSE
    if len(_POWERS) < n:
        size = max(n, 2 * len(_POWERS))
        up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POWERS, _INVERSE = np.multiply.accumulate(up), np.multiply.accumulate(down)


def words(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes with 0 for what is no word, start, end, row and 64-bit hash of each word) of texts side by side.

    A word's hash is a polynomial of its bytes modulo 2 ** 64, taken from prefix sums: no loop over words.
    """
    low = _LOW[data]
    n = len(low)
    into = low != 0
    first = np.zeros(n + 1, bool)
    first[offsets[:-1]] = True
    gap = ~into
    begins = into.copy()
    begins[1:] &= gap[:-1] | first[1:n]
    ends = into.copy()
    ends[:-1] &= gap[1:] | first[1:n]
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    h, k = np.empty(len(s), np.uint64), 0
    while k < len(s):  # sums over spans of bounded size, whatever the length of a text
        last = max(k + 1, int(np.searchsorted(s, s[k] + SPAN)))
        span = low[s[k] : e[last - 1]]
        _powers(len(span) + 1)
        sums = np.zeros(len(span) + 1, np.uint64)
        np.cumsum(span * _POWERS[: len(span)], out=sums[1:])
        h[k:last] = (sums[e[k:last] - s[k]] - sums[s[k:last] - s[k]]) * _INVERSE[s[k:last] - s[k]]
        k = last
    h ^= h >> np.uint64(31)
    h *= np.uint64(_STEP)
    h ^= h >> np.uint64(29)
    return low, s, e, np.searchsorted(offsets, s, "right") - 1, h


def rolled(h: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` words."""
    m = len(h) - length + 1
    out = np.zeros(max(m, 0), np.uint64)
    for k in range(length):
        out *= np.uint64(_BASE)
        out += h[k : k + m]
    out ^= out >> np.uint64(32)
    return out


class Windows:
    """All windows of test items in arrays, sorted by length and hash: the hash, the place of the words in the lower-cased test
    bytes to verify a hit, and the item. 20 bytes a window and the test bytes once: no Python object for a window."""

    def __init__(self, items: list[tuple[str | None, str]], window: int = WINDOW):
        self.items = sorted({item for item, _ in items if item is not None})
        place = {item: k for k, item in enumerate(self.items)}
        lows, found, at, base = [], {}, 0, 0
        while at < len(items):  # some items at a time: the arrays of ``words`` are many times the text
            size, end = 0, at
            while end < len(items) and (end == at or size < PIECE):
                size += len(items[end][1] or "")
                end += 1
            raw = [(text or "").encode() for _, text in items[at:end]]
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
            low, s, e, row, h = words(offsets, np.frombuffer(b"".join(raw), np.uint8))
            n = np.bincount(row, minlength=len(raw))
            own = np.array([-1 if item is None else place[item] for item, _ in items[at:end]], np.int32)
            for length in set(np.minimum(n[n > 0], window).tolist()):
                x = rolled(h, length)
                some = np.flatnonzero((row[: len(x)] == row[length - 1 :]) & (np.minimum(n, window)[row[: len(x)]] == length)) if len(x) else np.zeros(0, np.int64)
                found.setdefault(length, []).append((x[some], (base + s[some]).astype(np.int32), (base + e[some + length - 1]).astype(np.int32), own[row[some]]))
            lows.append(low.tobytes())
            base += len(low)
            at = end
        self.text = b"".join(lows)
        self.by_length = {}
        for length, parts in sorted(found.items()):
            h, start, stop, item = (np.concatenate(p) for p in zip(*parts))
            order = np.argsort(h, kind="stable")
            h = h[order]
            seen = np.zeros(1 << 20, bool)
            seen[(h >> np.uint64(44)).astype(np.int64)] = True
            self.by_length[length] = (h, seen, start[order], stop[order], item[order])
        self.longest = max(self.by_length, default=1)

    @staticmethod
    def spelt(raw: bytes) -> list[bytes]:
        """The words of lower-cased bytes."""
        return raw.replace(b"\0", b" ").split()

    def scan(self, offsets: np.ndarray, data: np.ndarray, cut: bool = True):
        """(words of each text, covered words as (row, first, last, first byte, end byte), items by row)."""
        if cut and len(offsets) == 2 and len(data) > LONG * PIECE:
            return self._scan_long(data)
        low, s, e, row, h = words(offsets, data)
        n = np.bincount(row, minlength=len(offsets) - 1)
        base = np.concatenate([[0], np.cumsum(n)])
        depth = np.zeros(len(s) + 1, np.int64)
        items: dict[int, set[str]] = {}
        raw = None
        for length, (table, seen, start, stop, item) in self.by_length.items():
            if len(s) < length:
                continue
            x = rolled(h, length)
            at = np.flatnonzero(seen[(x >> np.uint64(44)).astype(np.int64)] & (row[: len(x)] == row[length - 1 :]))
            near = np.searchsorted(table, x[at])
            there = table[np.minimum(near, len(table) - 1)] == x[at]
            at, near = at[there], near[there]
            ends = np.searchsorted(table, x[at], "right")
            for i, first, last in zip(at.tolist(), near.tolist(), ends.tolist()):
                raw = low.tobytes() if raw is None else raw
                mine = self.spelt(raw[s[i] : e[i + length - 1]])
                hit = [k for k in range(first, last) if self.spelt(self.text[start[k] : stop[k]]) == mine]
                if hit:
                    depth[i] += 1
                    depth[i + length] -= 1
                    items.setdefault(int(row[i]), set()).update(self.items[item[k]] for k in hit if item[k] >= 0)
        covered = np.flatnonzero(np.cumsum(depth[:-1]) > 0)
        spans = []
        if len(covered):
            cut = np.flatnonzero((np.diff(covered) > 1) | (np.diff(row[covered]) > 0)) + 1
            for run in np.split(covered, cut):
                r = int(row[run[0]])
                spans.append((r, int(run[0] - base[r]), int(run[-1] - base[r]), int(s[run[0]] - offsets[r]), int(e[run[-1]] - offsets[r])))
        return n, spans, items

    def _scan_long(self, data: np.ndarray):
        """One long text in pieces that end between words; the last words of a piece go before the next one, so no window is lost."""
        count, spans, items, at, back = 0, [], set(), 0, 0
        while at < len(data):
            end = at + PIECE
            while end < len(data) and _LOW[data[end]]:
                end += 1
            end = min(end, len(data))
            piece = data[at - back : end]
            offsets = np.array([0, len(piece)], np.int64)
            n, own, found = self.scan(offsets, piece, cut=False)
            _, s, _, _, _ = words(offsets, piece)
            before = count - int(np.searchsorted(s, back))
            spans += [(first + before, last + before, start + at - back, stop + at - back) for _, first, last, start, stop in own]
            items |= found.get(0, set())
            count = before + int(n[0])
            keep = min(self.longest - 1, len(s))
            back = len(piece) - int(s[len(s) - keep]) if keep else 0
            at = end
        return np.array([count]), [(0, *x) for x in merged(spans)], {0: items} if items else {}


STATE = "n_words long, spans array<struct<first:int,last:int,start:int,stop:int>>, items array<string>"
_SPAN = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("start", pa.int32()), ("stop", pa.int32())])


def _scanning(shared, keep_text: bool, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = shared.value
        for batch in batches:
            for part, off, data in rows_of(batch, PIECE, text):
                n, spans, items = windows.scan(off, data)
                of_row: list[list] = [[] for _ in range(len(n))]
                for r, *span in spans:
                    of_row[r].append(tuple(span))
                found = [sorted(items.get(r, ())) for r in range(len(n))]
                names = part.schema.names
                cols = {c: part.column(i) for i, c in enumerate(names)}
                cols["n_words"] = pa.array(n, pa.int64())
                cols["spans"] = pa.array([[dict(zip(("first", "last", "start", "stop"), x)) for x in row] for row in of_row], pa.list_(_SPAN))
                cols["items"] = pa.array(found, pa.list_(pa.string()))
                if not keep_text:
                    del cols[text]
                yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))

    return run


def merged(spans: list[tuple]) -> list[tuple]:
    """Spans of words united where they overlap or touch."""
    out: list[tuple] = []
    for x in sorted(spans):
        if out and x[0] <= out[-1][1] + 1:
            y = out[-1]
            out[-1] = (y[0], max(x[1], y[1]), y[2], max(x[3], y[3]))
        else:
            out.append(x)
    return out


def _state(docs: DataFrame, shared, keep_text: bool, text: str) -> DataFrame:
    kept = [f for f in docs.schema.fields if f.name not in ("n_words", "spans", "items") and (keep_text or f.name != text)]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), STATE])
    return docs.drop("n_words", "spans", "items").mapInArrow(_scanning(shared, keep_text, text), schema)


def _uniting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states of a row from several blocks of items as one."""
    for batch in batches:
        spans = [merged([(x["first"], x["last"], x["start"], x["stop"]) for part in row or () for x in part]) for row in batch.column(1).to_pylist()]
        items = [sorted({x for part in row or () for x in part}) for row in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([[dict(zip(("first", "last", "start", "stop"), x)) for x in row] for row in spans], pa.list_(_SPAN)), pa.array(items, pa.list_(pa.string()))], ["_row", "spans", "items"])


def hits(docs: DataFrame, bench: DataFrame, window: int = WINDOW, most_mb: float = BENCH_MB, keep_text: bool = False, text: str = "text", unnamed: str | None = "null") -> DataFrame:
    """``docs`` with n_words, spans (covered words and their bytes) and items (ids of test items with occurring windows).

    The test texts are measured first. Up to ``most_mb`` they are broadcast as one set of sorted hashes with the test bytes;
    beyond, they are cut into blocks of that size by hash. Then the documents are stored once with a row number, and pass the blocks
    in jobs of their own, each of which keeps only the rows that are hit, so one block at a time is in memory however many there
    are. Every window of every document is hashed in numpy, looked up, and verified by its words. Texts are taken in pieces of about
    1 MB, a longer one in several, cut between words (a word of more than 4 MB stays whole).

    Null or wordless texts have no words and no hits; null or wordless test texts have no windows; a null item id is listed as
    ``unnamed``, or not at all where that is None (its windows are hit all the same). An empty table gives an empty one; without
    test items nothing is hit. Repeated items count once; repeated rows keep a result each. Columns n_words, spans and items
    of ``docs`` are replaced; others stay.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_words", "spans", "items")
    bench = bench.select(F.col("item_id").cast("string").alias("item"), "text").where("text is not null")
    bench = bench.fillna({"item": unnamed}) if unnamed is not None else bench
    size = bench.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-int(size) // int(most_mb * 1e6)))
    if blocks == 1:
        return _state(docs, spark.sparkContext.broadcast(Windows([(r["item"], r["text"]) for r in bench.collect()], window)), keep_text, text)
    rows = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    found = []
    for k in range(blocks):
        block = bench.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        shared = spark.sparkContext.broadcast(Windows([(r["item"], r["text"]) for r in block.collect()], window))
        hit = _state(rows.select("_row", text), shared, False, text)
        found.append(stored(hit.select("_row", "n_words", "spans", "items") if k == 0 else hit.where(F.size("spans") > 0).select("_row", "n_words", "spans", "items"), f"block{k}"))
        shared.destroy()
    some = found[0].where(F.size("spans") > 0)
    for f in found[1:]:
        some = some.unionByName(f)
    united = some.groupBy("_row").agg(F.collect_list("spans").alias("spans"), F.collect_list("items").alias("items")).mapInArrow(_uniting, "_row long, " + STATE.split(", ", 1)[1])  # a row's blocks
    out = rows.join(found[0].select("_row", "n_words"), "_row").join(united, "_row", "left")
    none = F.from_json(F.lit("[]"), "array<struct<first:int,last:int,start:int,stop:int>>")
    out = out.withColumn("spans", F.coalesce("spans", none)).withColumn("items", F.coalesce("items", F.array().cast("array<string>"))).drop("_row")
    return out if keep_text else out.drop(text)


def without_spans(hit: DataFrame, text: str = "text") -> DataFrame:
    """The texts of ``hits(..., keep_text=True)`` with all covered spans cut out, byte by byte."""
    raw = F.encode(text, "UTF-8")
    stops = F.concat(F.array(F.lit(0)), F.transform("spans", lambda x: x["stop"]))
    starts = F.concat(F.transform("spans", lambda x: x["start"]), F.array(F.octet_length(text)))
    parts = F.zip_with(stops, starts, lambda a, b: F.decode(F.substring(raw, a + 1, b - a), "UTF-8"))
    return hit.withColumn(text, F.when(F.size("spans") > 0, F.array_join(parts, "")).otherwise(F.col(text)))


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document."""
    hit = hits(load(spark, sf_dir, "documents").select("doc_id", "text"), load(spark, sf_dir, "benchmark"), unnamed=None)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["last"] - x["first"] + 1)
    return hit.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = f"""
with b as (select item_id::varchar as item, {_WORDS} as w from benchmark),
win as (select distinct item, least(10, len(w)) as n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') as g
  from (select item, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i from b where len(w) > 0)),
d as (select row_number() over () as r, doc_id, coalesce({_WORDS}, []) as w from documents),
sizes as (select distinct n from win),
dw as (select r, n, i, array_to_string(w[i : i + n - 1], ' ') as g from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from d, sizes where len(w) >= n)),
hit as (select r, i, dw.n, item from dw join win on dw.g = win.g and dw.n = win.n),
covered as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from hit) group by r),
named as (select r, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items from hit group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join covered using (r) left join named using (r)
"""
