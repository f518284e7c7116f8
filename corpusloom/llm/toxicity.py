"""Toxicity of whole texts by a recurrent network over all overlapping windows (operator 6)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm import gru
from corpusloom.llm.arrow import rows_of
from corpusloom.llm.common import crc_of_id, load
from corpusloom.llm.decontamination import words

PER_CLASS = 1500
MOST_BYTES = 20_000
PIECE = 1 << 19


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, most_bytes: int = MOST_BYTES) -> gru.Network | None:
    """Train on the driver from a bounded sample: of each class ``per_class`` labelled rows at most, by a hash of their id, and
    of these the texts of ``most_bytes`` at most; of their windows at most 60,000 are learned from (``most_windows`` of ``gru.trained``). A row of ``labels`` with a null id or label is no label; of several labels of
    an id the largest holds."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    mark = F.xxhash64("doc_id", F.lit(11))
    chosen = [known.where(F.col("toxic") == k).orderBy(mark, "doc_id").limit(per_class) for k in (0, 1)]
    sample = F.broadcast(chosen[0].unionAll(chosen[1]))  # 2 x per_class short rows at most
    rows = docs.select("doc_id", "text").where(F.octet_length("text") <= most_bytes).join(sample, "doc_id").select("doc_id", "text", "toxic", F.xxhash64("doc_id", "text").alias("h")).orderBy("h").limit(2 * per_class).collect()
    return gru.trained([r["text"].encode() for r in rows], [r["toxic"] for r in rows])


def _best(net: gru.Network, off: np.ndarray, data: np.ndarray) -> np.ndarray:
    """The largest probability of the windows of each text."""
    best = np.zeros(len(off) - 1, np.float32)
    if len(data):
        number, row, *codes = gru.spelt(off, data)
        where, own = gru.windows(row, len(best))
        if len(where):
            said = net.scores(net.inputs(*net.numbered(*codes)), np.where(where == gru.PAD, gru.PAD, number[np.maximum(where, 0)]))
            np.maximum.at(best, own, said)
    return best


def best_of_long(net: gru.Network, data: np.ndarray, piece: int = PIECE) -> float:
    """The same for one long text, in pieces cut where a window begins: the windows are those of the whole text."""
    best, at, seen = 0.0, 0, False
    while at < len(data):
        end = min(at + piece, len(data))
        _, s, e, _, _ = words(np.array([0, end - at], np.int64), data[at:end])
        last = end == len(data)
        n = len(s) if last else max(0, len(s) - 1)  # the last word of a piece may go on
        full = (n - gru.LENGTH) // gru.STRIDE if n >= gru.LENGTH else -1
        if last:
            if n > gru.LENGTH - gru.STRIDE or not seen:
                best = max(best, float(_best(net, np.array([0, end - at], np.int64), data[at:end])[0]))
            return best
        if full < 0:  # no whole window in the piece
            piece *= 2
            continue
        stop = int(e[full * gru.STRIDE + gru.LENGTH - 1])
        best = max(best, float(_best(net, np.array([0, stop], np.int64), data[at : at + stop])[0]))
        at, seen = at + int(s[(full + 1) * gru.STRIDE]), True
    return best


def _scoring(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for part, off, data in rows_of(batch, PIECE):
                if net is None:
                    best = np.zeros(len(off) - 1, np.float32)
                else:
                    best = np.array([best_of_long(net, data)], np.float32) if len(data) > 2 * PIECE else _best(net, off, data)
                rest = [i for i in range(part.num_columns) if i != at]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in rest), pa.array(best.astype(np.float64))], [*(part.schema.names[i] for i in rest), "score"])

    return run


def scored(docs: DataFrame, net: gru.Network | None) -> DataFrame:
    """``docs`` with ``score`` in place of text: the largest probability of its windows of 32 words, each 24 words after the last.

    Whole texts are read, in one pass without a shuffle. Texts that are null or have no words score 0; so does all if there was
    nothing to learn from. Repeated rows keep a score each. A column score of ``docs`` is replaced, others stay. An empty table gives
    an empty one. Texts of more than 1 MB are scored in pieces that are cut where a window begins.
    """
    docs = docs.drop("score")
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text")
    return docs.mapInArrow(_scoring(docs.sparkSession.sparkContext.broadcast(net)), f"{kept}, score double")


def op6_toxicity(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score and predicted of every document; labels are learned from rows that aren't held out."""
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    held = F.pmod(crc_of_id(), F.lit(5)) == 0
    net = fit(docs.where(~held), labels.where(~held))
    out = scored(docs.select("doc_id", held.alias("held_out"), "text"), net)
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
