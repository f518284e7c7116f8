"""The training-data operators against brute force on small tables with the awkward rows: nulls, empty and long texts, ties,
repeats, empty tables, clashing column names."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corpusloom.llm import decontamination, embeddings, gru, html_text, language_id, mixing, sharding, simhash, token_counts, toxicity, warc
from corpusloom.llm.common import connected_components
from tests.conftest import DATA, same

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "palabra " * 30_000
ROWS = [(1, "The cat sat on the mat and the dog ran", "en", "b", 1), (2, "the CAT sat on the mat and the dog ran", "en", "a", 1), (3, None, "en", None, None), (4, "", None, "a", 0), (5, LONG, "es", "a", 1), (6, " \t\n", "de", "b", 3), (7, "Der Hund und die Katze", "de", "", 1),
        (7, "Der Hund und die Katze", "de", "", 1), (7, "otro texto distinto", "es", "b", 1), (None, "no id here at all my friend", "en", "c", 1), (8, "The cat sat on the mat and the dog ran", "en", "b", 1), (9, "123 !!! ###", "en", "a", 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def components(n: int, linked) -> list[int]:
    up = list(range(n))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


# ---- common


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(200, 200), (300, 301), (301, 300)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert all(got[i] == 0 for i in range(41)) and all(got[x] == 100 for x in range(100, 160)) and got[301] == 300 and 200 not in got
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- 1


def test_language_profiles(spark, docs, none):
    rng = np.random.default_rng(0)
    words = {"xx": ["kala", "meri", "talo", "vesi"], "yy": ["brod", "smak", "tjog", "kvist"]}
    rows = [(int(i), " ".join(rng.choice(words[k], 30)), k, "s", 1) for i, k in enumerate(["xx", "yy"] * 60)]
    df = spark.createDataFrame([*rows, (999, None, "xx", "s", 1), (1000, "kala", None, "s", 1)], DOCS)
    p = language_id.fit(df.where("doc_id < 80").select("text", "lang"))
    said = {r["doc_id"]: r for r in language_id.identify(df.withColumn("score", F.lit("clash")), p).collect()}
    assert all(said[i]["lang_pred"] == k for i, _, k, _, _ in rows) and said[999]["lang_pred"] == "und" and said[1000]["lang_pred"] == "xx"
    assert all(0 <= r["score"] <= 1 for r in said.values())
    got = language_id.identify(docs, p)
    assert got.count() == len(ROWS) and {r["lang_pred"] for r in got.where("text is null or text rlike '^[^a-zA-Z]*$'").collect()} == {"und"}
    assert language_id.identify(none, p).count() == 0
    assert language_id.identify(docs, language_id.fit(none.select("text", "lang"))).where("lang_pred <> 'und'").count() == 0


def test_grams_and_ranks_by_brute_force():
    texts = ["Ab a, b!", "", "ÉÉ 𝐀x", "a b"]
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    got = language_id.grams(off, np.frombuffer(b"".join(raw), np.uint8))
    for t, codes in zip(texts, got):
        want = []
        for w in "".join(ch if ch.isalpha() else " " for ch in t).lower().split():
            s = [1, *map(ord, w), 1]
            want += s[1:-1] + [(s[i] << 21) | s[i + 1] for i in range(len(s) - 1)] + [(s[i] << 42) | (s[i + 1] << 21) | s[i + 2] for i in range(len(s) - 2)]
        assert sorted(codes.tolist()) == sorted(want)
    codes = np.random.default_rng(1).integers(0, 50, 4000)
    values, n = np.unique(codes, return_counts=True)
    want = [v for _, v in sorted(zip(-n, values))]
    assert language_id.ranked(codes, 7).tolist() == want[:7] and language_id.ranked(codes, 40).tolist() == want[:40]


def test_language_query_is_accurate(spark):
    got = language_id.op1_language_id(spark, DATA)
    truth = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").collect()
    assert len(rows) == 200 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)


# ---- 2


def test_decontamination_query(spark):
    same(decontamination.op2_decontamination(spark, DATA), decontamination.SQL)


def test_decontamination_cases(spark, docs, none):
    items = spark.createDataFrame([(1, "cat SAT on"), (2, None), (3, "!!"), (None, "Hund und"), (4, "on the mat and the dog ran x y z w"), (5, "palabra " * 12), (5, "texto")], "item_id long, text string")
    got = decontamination.hits(docs.withColumn("items", F.lit("clash")), items, keep_text=True)
    rows = [(r["doc_id"], r["n_words"], [tuple(s)[:2] for s in r["spans"]], r["items"]) for r in got.collect()]
    assert len(rows) == len(ROWS) and [x for x in rows if x[0] == 2] == [(2, 10, [(1, 3)], ["1"])]
    assert [x for x in rows if x[0] == 3] == [(3, 0, [], [])] and sorted(x[3] for x in rows if x[0] == 7) == [["5"], ["null"], ["null"]]
    assert [x for x in rows if x[0] == 5] == [(5, 30_000, [(0, 29_999)], ["5"])]
    key = lambda r: (str(r["doc_id"]), str(r["spans"]), str(r["items"]))
    blocks = decontamination.hits(docs, items, most_mb=0.00002, keep_text=True)
    assert sorted(map(key, blocks.collect())) == sorted(map(key, got.collect()))
    clean = {r["doc_id"]: r["text"] for r in decontamination.without_spans(got).where("doc_id <> 7").collect()}
    assert clean[2] == "the  the mat and the dog ran" and clean[3] is None and clean[9] == "123 !!! ###"
    assert decontamination.hits(docs, items.limit(0)).where("size(spans) > 0").count() == 0 and decontamination.hits(none, items).count() == 0


# ---- 3


def test_sharding_cases(spark, docs, none):
    rows = sorted(sharding.shards(docs, 4).collect(), key=lambda r: (r["shard"], r["slot"]))
    assert len(rows) == len(ROWS) and [r["doc_id"] for r in rows if r["doc_id"] is not None] == sorted(x[0] for x in ROWS if x[0] is not None) and rows[0]["doc_id"] is None
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(s == list(range(len(s))) for s in by.values())
    assert sorted(r["text_crc32"] for r in rows) == sorted(zlib.crc32((x[1] or "").encode()) for x in ROWS) and all(r["size"] >= 16 for r in rows)
    assert sharding.shards(none, 4).count() == 0


def test_sharding_balance(spark):
    rows = sharding.op3_sharding(spark, DATA).groupBy("shard").agg(F.sum("size").alias("b"), F.max("slot").alias("m"), F.count("*").alias("n")).collect()
    sizes = spark.read.parquet(f"{DATA}/documents.parquet").select((F.octet_length("text") + 16).alias("s")).agg(F.sum("s"), F.max("s")).first()
    assert all(abs(r["b"] - sizes[0] / 40) <= sizes[1] and r["m"] == r["n"] - 1 for r in rows)


# ---- 4


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(120, 16))
    near = base[:60] + rng.normal(size=(60, 16)) * 0.05 * rng.random((60, 1)) * 5
    rows = [(i, [float(np.float32(v)) for v in x]) for i, x in enumerate(np.vstack([base, near, base[:5] * 2, np.repeat(base[:1], 40, 0) + rng.normal(size=(40, 16)) * 0.01]))]
    good = len(rows)
    rows += [(500, None), (501, []), (502, [0.0] * 16), (503, [float("nan")] * 16), (504, [1.0, None] * 8), (505, [float("inf")] * 16), (506, rows[7][1]), (507, rows[7][1]), (507, rows[7][1]), (None, rows[3][1]), (508, rows[9][1][:8])]
    got = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("n_links", F.lit("clash")).repartition(3)).collect()
    assert len(got) == len(rows)
    valid = [r for r in rows if r[1] and len(r[1]) == 16 and all(v is not None and np.isfinite(v) for v in r[1]) and any(r[1])]
    x = np.array([r[1] for r in valid])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = x @ x.T >= 0.95
    comp = components(len(valid), lambda i, j: links[i, j])
    names = {}
    for r, k in zip(valid, comp):
        names.setdefault(k, []).append(r[0])
    want = sorted((str(r[0]), int(links[i].sum() - 1), min(v for v in names[comp[i]] if v is not None)) for i, r in enumerate(valid))
    ids = {str(r[0]) for r in valid}
    assert sorted((str(r["vec_id"]), r["n_links"], r["component_id"]) for r in got if str(r["vec_id"]) in ids) == want and good > 200
    rest = [r for r in got if r["vec_id"] is not None and 500 <= r["vec_id"] <= 505 or r["vec_id"] == 508]
    assert all(r["n_links"] == 0 and r["component_id"] == r["vec_id"] and r["kept"] for r in rest) and len(rest) == 7
    assert embeddings.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_vector_recall_at_the_threshold(spark):
    rng = np.random.default_rng(0)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    a = unit(rng.normal(size=(1500, 64)))
    w = rng.normal(size=(500, 64))
    w = unit(w - (w * a[:500]).sum(1, keepdims=True) * a[:500])
    c = 0.9501 + 0.01 * rng.random((500, 1))
    x = np.vstack([a, c * a[:500] + np.sqrt(1 - c * c) * w])
    got = {r["vec_id"]: r["n_links"] for r in embeddings.near_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()}
    true = (x @ x.T >= 0.95).sum(1) - 1
    assert sum(got.values()) >= 0.95 * true.sum() and all(got[i] <= true[i] for i in got)


@pytest.mark.parametrize("rows, cosine", [(700, 0.98), (4000, 0.97), (10_000, 0.98)])
def test_vector_links_in_a_group_of_near_copies(spark, rows, cosine):
    rng = np.random.default_rng(rows)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    x = unit(rng.normal(size=(rows, 64)))
    x[: rows // 3] = unit(x[0] + x[: rows // 3] * np.sqrt(1 / cosine - 1))
    got = {r["vec_id"]: r["n_links"] for r in embeddings.near_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()}
    true = (x @ x.T >= 0.95).sum(1) - 1
    assert true.sum() > 0.9 * (rows // 3) ** 2 and got == dict(enumerate(true.tolist()))


# ---- 5


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><script>var t="</p>";</script></head><body class="x"><header>Site</header><nav><ul><li><a href="/a">A</a></ul></nav>
<div class="sidebar">side</div><article><h1>Head &lt;1&gt;</h1><p><b>One  two\n three<br>four<p>Five <i>six</i><!-- <p>no --><aside>aside</aside><ul><li>li 1<li>li 2</ul>
<form><input><p>form</p></form><section id="comments"><p>reader</p></section><div class="share-bar">share</div></article><footer>&copy; foot</footer></body></html>"""


def test_html_cases(spark):
    rows = [(1, "https://h.x/1", PAGE), (2, None, None), (3, "rel", ""), (4, "https://h.x/4", "<p>un<b>closed &euro;&#8364; a < b"), (4, "https://h.x/4", "plain"), (5, "https://h.x/5", "<div class=ad>x</div><main><p>m</main><p>out"), (6, "h", "<script>never closed <p>x")]
    got = {(r["page_id"], r["url"], r["text"], r["n_chars"]) for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))).collect()}
    want = {1: "Head <1>\n\nOne two three four\n\nFive six\n\nli 1\n\nli 2", 2: "", 3: "", 5: "m", 6: ""}
    assert {(i, t) for i, _, t, _ in got if i in want} == set(want.items())
    assert {t for i, _, t, _ in got if i == 4} == {"unclosed €€ a < b", "plain"} and all(n == len(t) for _, _, t, n in got)
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_style_tree_finds_branches_that_nothing_declares(spark):
    rng = np.random.default_rng(2)
    text = lambda: " ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(12))
    body = [text() for _ in range(30)]
    pages = [(i, f"https://site.x/{i}", f"<html><body><div class=strip><p>Same words on each page</p><p>Twice</p></div><div class=story><p>{body[i]}</p><p>{text()}</p></div></body></html>") for i in range(30)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_text.extract(df).collect()}
    assert all("Same words" not in t and "Twice" not in t and t.startswith(body[i]) and t.count("\n\n") == 1 for i, t in got.items())
    tree = {r["path"]: r for r in html_text.style_tree(html_text.measured(df)).collect()}
    assert tree["/html/body/div.strip/p"]["content"] < 0.05 and tree["/html/body/div.story/p"]["content"] > 0.95
    few = {r["page_id"]: r["text"] for r in html_text.extract(df.where("page_id < 2")).collect()}
    assert all("Same words" in t for t in few.values())  # a tree of two pages says nothing


def test_html_shuffled_join_gives_the_same(spark, monkeypatch):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    one = {tuple(r) for r in html_text.extract(pages).collect()}
    monkeypatch.setattr(html_text, "MOST_HOSTS", -1)
    assert {tuple(r) for r in html_text.extract(pages).collect()} == one and len(one) == pages.count()


# ---- 6


def test_gradients():
    texts = [b"one two three four loser", b"der die das und lowei", b"a b c d e f g", b"one two three four"]
    s = gru.Sample(texts)
    at, _ = gru.windows(s.row.astype(np.int64), 4)
    at = np.where(at < 0, -1, s.number[np.maximum(at, 0)])
    y = np.array([1, 0, 1, 0], np.float32)
    kept = {}

    class Still(gru.Network):
        def _adam(self, grad, rate):
            kept.update(grad)

    net = Still(np.sort(s.words), np.unique(s.grams))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    bucket, grams, starts = net.numbered(s.words, s.grams, s.starts)
    net.step(bucket, grams, starts, at, y, 0)

    def loss():
        p = net.scores(net.inputs(bucket, grams, starts), at).astype(float)
        return -np.log(np.where(y > 0.5, p, 1 - p)).mean()

    for k, g in kept.items():
        i = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, e = net.p[k][i], 1e-2
        net.p[k][i] = old + e
        up = loss()
        net.p[k][i] = old - e
        down = loss()
        net.p[k][i] = old
        assert abs((up - down) / (2 * e) - g[i]) < 2e-4, k


def test_windows_cover_all_words():
    rng = np.random.default_rng(4)
    n = rng.integers(0, 200, 50)
    row = np.repeat(np.arange(50), n)
    at, own = gru.windows(row, 50)
    assert set(at[at >= 0].tolist()) == set(range(len(row))) and all((row[a[a >= 0]] == o).all() and (np.diff(np.flatnonzero(a >= 0)) == 1).all() for a, o in zip(at, own))
    assert (np.bincount(own, minlength=50) == [0 if k == 0 else 1 if k <= gru.LENGTH else -(-(k - gru.LENGTH) // gru.STRIDE) + 1 for k in n]).all()


def test_toxicity_learns_and_handles_cases(spark, docs, none):
    rng = np.random.default_rng(5)
    plain = ["".join(rng.choice(list("etaoinsr"), rng.integers(2, 7))) for _ in range(300)]
    rows, labels = [], []
    for i in range(400):
        words = list(rng.choice(plain, rng.integers(10, 150)))
        if i % 4 == 0:
            words.insert(int(rng.integers(0, len(words))), "zqx" + "".join(rng.choice(list("abc"), 3)))
        rows.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, 1 if i % 4 == 0 else 0))
    df, lab = spark.createDataFrame(rows, DOCS), spark.createDataFrame([*labels, (None, 1), (7, None), (7, 0)], "doc_id long, toxic int")
    net = toxicity.fit(df.where("doc_id < 300"), lab.where("doc_id < 300 or doc_id is null"))
    got = {r["doc_id"]: r["score"] >= 0.5 for r in toxicity.scored(df.where("doc_id >= 300"), net).collect()}
    assert sum(got[i] == (i % 4 == 0) for i in got) >= 0.93 * len(got)
    odd = toxicity.scored(docs.withColumn("score", F.lit("clash")), net).collect()
    assert len(odd) == len(ROWS) and all(0 <= r["score"] <= 1 for r in odd) and [r["score"] for r in odd if r["doc_id"] == 3] == [0.0]
    assert toxicity.scored(none, net).count() == 0 and toxicity.fit(none, lab) is None and toxicity.scored(docs, None).where("score > 0").count() == 0


# ---- 7


def test_warc_query(spark):
    same(warc.op7_warc(spark, DATA), warc.SQL)


def test_warc_round_trip(spark, tmp_path):
    mark = "\r\n\r\nWARC/1.1\r\nWARC-Type: x"
    bodies = ["", None, "a" * 99, "b" * 100, "b" * 100, "b" * 100, "c" * 70_000 + "\r\n", "é" * 150_000, "é" * 150_000, "x" * 120 + mark + "\r\n" + "y" * 100 + mark * 3, "\r\n" * 200, "ends\r\n\r\n" * 50, "z" * 65_535 + mark, "\r\n\r\nWARC/1.1\r\n" * 5 + "q" * 100, "k" * 65_536, "k" * 65_537]
    rows = [(i, f"u\r\n{i}" if i % 3 else None, b) for i, b in enumerate(bodies)] + [(3, "u3", "b" * 100)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload_digest", F.lit("clash")).repartition(3)
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    same(warc.op7_warc(spark, str(tmp_path)), warc.SQL, str(tmp_path))
    found = warc.records(spark, warc.archive(warc.chunks(warc.originals(pages.drop("payload_digest"))))).collect()
    by = {}
    for r in found:
        if r["kind"] != "revisit":
            by.setdefault((r["page_id"], r["record_id"]), {})[r["chunk"]] = r["data"]
    for (page, _), parts in by.items():
        assert "".join(parts[k] for k in range(len(parts))) == (bodies[page] or "")
    assert max(len(p) for p in by.values()) > 2 and len(by) == 14
    assert warc.op7_warc(spark, _empty_pages(spark, tmp_path)).count() == 0


def test_warc_payloads_that_begin_like_a_record(spark, tmp_path):
    start = "WARC/1.1\r\n"
    bodies = [start + "WARC-Type: x\r\n\r\n" + "a" * 100, "WARC/1.1", start, start * 3, "w" * 65_536 + start + "v", "w" * 65_533 + start, "in WARC/1.1 prose"]
    pages = spark.createDataFrame(list(enumerate(bodies)), "page_id long, html string").withColumn("url", F.lit("u"))
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    same(warc.op7_warc(spark, str(tmp_path)), warc.SQL, str(tmp_path))
    by = {}
    for r in warc.records(spark, warc.archive(warc.chunks(warc.originals(pages)))).collect():
        by.setdefault(r["page_id"], {})[r["chunk"]] = r["data"]
    assert {p: "".join(parts[k] for k in range(len(parts))) for p, parts in by.items()} == dict(enumerate(bodies))


def _empty_pages(spark, tmp_path) -> str:
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(f"{tmp_path}/none/pages.parquet")
    return f"{tmp_path}/none"


# ---- 8


def brute_fingerprint(text: str | None) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(ch) + 32) if "A" <= ch <= "Z" else ch for ch in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_cases(spark, docs, none):
    got = simhash.classes(docs.select("doc_id", "text", F.lit("clash").alias("fp"))).collect()
    want = [(x[0], brute_fingerprint(x[1])) for x in ROWS]
    comp = components(len(want), lambda i, j: (want[i][1] ^ want[j][1]).bit_count() <= 4)
    names = {}
    for (i, _), k in zip(want, comp):
        names.setdefault(k, []).append(i)
    full = sorted((str(i), f, str(min((v for v in names[k] if v is not None), default=None))) for (i, f), k in zip(want, comp))
    assert sorted((str(r["doc_id"]), r["fp"] % (1 << 64), str(r["component_id"])) for r in got) == full
    assert simhash.classes(none.select("doc_id", "text")).count() == 0
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "3", "5", "7", "7", "9", "None"]


def test_links_of_near_fingerprints(spark):
    rng = np.random.default_rng(6)
    base = rng.integers(-(1 << 63), 1 << 63, 40, dtype=np.int64)
    fps = set(base.tolist())
    for x in base[:25].tolist():
        for _ in range(30):
            y = x % (1 << 64)
            for b in rng.choice(64, int(rng.integers(1, 8)), replace=False):
                y ^= 1 << int(b)
            fps.add(y - (1 << 64) if y >= 1 << 63 else y)
    fps = sorted(fps)
    u = np.array(fps, np.int64).view(np.uint64)
    near = np.bitwise_count(u[:, None] ^ u[None, :]) <= 4
    comp = components(len(fps), lambda i, j: near[i, j])
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    for limit in (4096, 8):  # with long runs dealt in blocks, too
        got = dict(map(tuple, connected_components(simhash.links(df, limit=limit)).collect()))
        assert [got.get(x, x) for x in fps] == [fps[k] for k in comp]
    assert simhash.segments(4) == [(0, 21), (21, 22), (43, 21)]


# ---- 9


def test_token_counts(spark, docs, none):
    scores = token_counts.pieces()
    trie = token_counts.Trie(scores, most_nodes=200)

    def brute(word):
        x = token_counts.SPACE + word
        best = [(0.0, 0)]
        for i in range(1, len(x) + 1):
            some = [(best[i - 1][0] + trie.unknown, -(-best[i - 1][1] + len(x[i - 1].encode())))]
            some += [(best[j][0] + scores[x[j:i]], best[j][1] - 1) for j in range(i) if x[j:i] in scores]
            best.append(max(some))
        return -best[-1][1]

    text = [r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").limit(20).collect()]
    words = sorted({w for t in text for w in t.split()})[:1500] + ["日本語", "🙂x", "\x00", "a" * 50]
    assert [trie[w.encode()] for w in words] == [brute(w) for w in words]
    got = sorted((str(r["doc_id"]), r["n_pretokens"], r["n_tokens"]) for r in token_counts.token_counts(docs.withColumn("n_tokens", F.lit("clash"))).collect())
    split = [re.findall(r"[^\x20\x09-\x0D]+", x[1] or "") for x in ROWS]
    assert got == sorted((str(x[0]), len(w), sum(map(brute, w)) if len(set(w)) < 50 else 0) for x, w in zip(ROWS, split))
    assert token_counts.token_counts(none).count() == 0


def test_token_counts_as_the_library(spark):
    from tokenizers import Tokenizer, models

    scores = token_counts.pieces()
    own = Tokenizer(models.Unigram([("<unk>", -30.0), *scores.items()], 0))
    trie = token_counts.Trie(scores)
    text = " ".join(r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").limit(5).collect())
    words = sorted(set(text.split()))
    same_count = sum(len(own.encode(token_counts.SPACE + w).tokens) == trie[w.encode()] for w in words)
    assert same_count >= 0.99 * len(words)  # they may choose otherwise among equal scores


# ---- 10


def test_mixing_targets(spark):
    df = spark.createDataFrame([("b", 10), ("a", 100), (None, 1), ("c", 0)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    # weights a 1, b 2, c 3, null 1; b stops at 30, null at 3, c at 0, a takes the rest
    assert got == {"a": 78.0, "b": 30.0, "c": 0.0, None: 3.0}


def test_mixing_cases(spark, docs, none):
    plan = mixing.copies(docs)
    assert sum(r["n"] for r in plan.collect()) == len(ROWS)
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns and mix.where("text is null or trim(text) = ''").count() <= 9
    assert mixing.copies(none).count() == 0 and mixing.mixed(none).count() == 0


def test_mixing_comes_near_its_targets_and_repeats(spark):
    one, two = (mixing.op10_mixing(spark, DATA).orderBy("doc_id").toPandas() for _ in range(2))
    assert one.equals(two) and (one.taken <= 3 * one["size"]).all() and len(one) == 200
    text = spark.read.parquet(f"{DATA}/documents.parquet").toPandas().set_index("doc_id")
    assert all(len(re.findall(r"[^\x20\x09-\x0D]+", text.text[i])) == n for i, n in zip(one.doc_id, one["size"]))
    one["source"] = text.source[one.doc_id].to_numpy()
    g = one.groupby("source").agg(target=("target", "first"), taken=("taken", "sum"), most=("size", "max"))
    assert ((g.target - g.taken).abs() <= g.most / 2 + 1e-6).all() and abs(g.target.sum() - one["size"].sum()) < 1e-6


def test_pairing_levels_agree_in_mass(spark):
    rows = [(i, "w " * int(n), "en", "hot" if i % 3 else "x", 1) for i, n in enumerate(np.random.default_rng(8).integers(1, 60, 600))]
    plan = mixing.copies(spark.createDataFrame(rows, DOCS), group=16)
    got = plan.groupBy("source").agg(F.first("target").alias("t"), F.sum(F.col("size") * F.col("copies") * F.col("n")).alias("k")).collect()
    assert all(abs(r["t"] - r["k"]) <= 30 for r in got) and plan.agg(F.sum("n")).first()[0] == 600


def test_long_texts_in_pieces(monkeypatch):
    rng = np.random.default_rng(9)
    text = " ".join("".join(rng.choice(list("abcdé"), rng.integers(1, 9))) for _ in range(4000)) + " 日本語のテキスト" * 50
    raw = np.frombuffer(text.encode(), np.uint8)
    whole = language_id.grams(np.array([0, len(raw)]), raw)[0]
    found, count = language_id.counts_of_long(raw, piece=500)
    values, n = np.unique(whole, return_counts=True)
    assert (found == values).all() and (count == n).all()
    off = np.array([0, 700, 700, len(raw)], np.int64)
    one = decontamination.words(off, raw)
    monkeypatch.setattr(decontamination, "SPAN", 64)
    assert all((a == b).all() for a, b in zip(one, decontamination.words(off, raw)))
