"""The pipeline against a plain Python version of its stages."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from corpusloom.llm.common import stored
from tests.conftest import DATA
from tests.llm.test_operators import DOCS, ROWS, brute_fingerprint, components

flow = pytest.importorskip("corpus_pipeline")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t))


def windows(w):
    n = min(10, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {i: t for i, t in rows.items() if re.search(r"[^\W\d_]", t)}
    ids = sorted(kept)
    fp = [brute_fingerprint(kept[i]) for i in ids]
    comp = components(len(ids), lambda i, j: (fp[i] ^ fp[j]).bit_count() <= 4)
    one = {ids[k] for k in set(comp)}
    test = [w for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect() if (w := windows(words(r["text"])))]
    sizes = {len(next(iter(w))) for w in test}
    every = set().union(*test)
    leaks = {i for i in one if any(tuple((w := words(kept[i]))[k : k + n]) in every for n in sizes for k in range(len(words(kept[i])) - n + 1))}
    got = docs
    for (name, stage), want in zip(flow.STAGES, (set(kept), one, one - leaks)):
        got = stored(stage(spark, got, DATA), name)
        assert {r["doc_id"] for r in got.select("doc_id").collect()} == want and got.columns == docs.columns and got.count() == len(want), name
    mixed = stored(flow.STAGES[3][1](spark, got, DATA), "mixing")
    last = flow.STAGES[4][1](spark, mixed, DATA)
    assert sorted(r["doc_id"] for r in mixed.collect()) == sorted(r["doc_id"] for r in last.collect()) and mixed.columns == docs.columns
    assert max(mixed.groupBy("doc_id").count().toPandas()["count"]) <= 3
    whole = flow.run(spark, DATA)
    assert sorted(map(tuple, whole.drop("slot", "shard").collect())) == sorted(map(tuple, last.drop("slot", "shard").collect()))


def test_stages_on_awkward_rows(spark):
    for rows in (ROWS, []):
        got = spark.createDataFrame(rows, DOCS)
        for name, stage in flow.STAGES:
            got = stored(stage(spark, got, DATA), name)
        assert got.count() >= (3 if rows else 0)


def test_stages_keep_columns_of_clashing_names(spark):
    extra = ["score", "Items", "spans", "n_words", "lang_pred", "_h", "h", "_id", "class_fp", "copies", "_copy", "_text_h", "fp", "component_id", "size", "u", "bucket", "open", "n", "shard"]
    docs = spark.createDataFrame(ROWS, DOCS)
    for i, name in enumerate(extra):
        docs = docs.withColumn(name, F.lit(i))
    got = docs
    for name, stage in flow.STAGES[:-1]:
        got = stored(stage(spark, got, DATA), name)
        assert got.columns == docs.columns, name
        assert all(tuple(r[c] for c in extra) == tuple(range(len(extra))) for r in got.collect()), name
    assert flow.STAGES[-1][1](spark, got, DATA).count() == got.count()


def test_last_stages_by_brute_force(spark):
    """Mixing comes near the targets of its input by words, and shards hold all columns in one order, cut at equal bytes."""
    docs = stored(spark.read.parquet(f"{DATA}/documents.parquet").where("text is not null"), "input")
    rows = docs.collect()
    size = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for r in rows}
    total = {}
    for r in rows:
        total[r["source"]] = total.get(r["source"], 0) + size[r["doc_id"]]
    names = sorted(total, key=lambda x: (x is None, x or ""))
    weight = {x: [1, 2, 3][i % 3] for i, x in enumerate(names)}
    target, left, free = {}, float(sum(total.values())), set(names)
    while free:
        share = {x: left * weight[x] / sum(weight[y] for y in free) for x in free}
        above = [x for x in free if share[x] > 3 * total[x] + 1e-9]
        if not above:
            target |= share
            break
        for x in above:
            target[x] = 3.0 * total[x]
            left -= target[x]
            free.remove(x)
    mixed = stored(flow.STAGES[3][1](spark, docs, DATA), "mixing")
    taken, most = dict.fromkeys(names, 0), dict.fromkeys(names, 0)
    for r in mixed.collect():
        taken[r["source"]] += size[r["doc_id"]]
    for r in rows:
        most[r["source"]] = max(most[r["source"]], size[r["doc_id"]])
    assert all(abs(taken[x] - target[x]) <= most[x] / 2 + 1e-6 for x in names)
    last = flow.STAGES[4][1](spark, mixed, DATA)
    assert set(docs.columns) < set(last.columns)
    own = [tuple(r[c] for c in docs.columns) for r in mixed.collect()]
    assert sorted(map(str, own)) == sorted(str(tuple(r[c] for c in docs.columns)) for r in last.collect())
    placed = sorted(last.collect(), key=lambda r: (r["shard"], r["slot"]))
    assert [(r["doc_id"], r["text_crc32"]) for r in placed] == sorted((r["doc_id"], r["text_crc32"]) for r in placed)
    whole, seen = sum(len(r["text"].encode()) + 16 for r in placed), 0
    for r in placed:
        n = len(r["text"].encode()) + 16
        assert r["size"] == n and r["shard"] == min(39, (2 * seen + n) * 40 // (2 * whole))
        seen += n
