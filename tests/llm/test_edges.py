"""The training-data operators beyond the small cases: brute-force versions, hot keys, very long texts, bounds that are refused."""

from __future__ import annotations

import gzip
import hashlib
import math
import os
import pickle
import time
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

from corpusloom.llm import common, decontamination, embeddings, gru, html_text, language_id, mixing, sharding, simhash, token_counts, toxicity, warc, xxh
from tests.conftest import DATA, same
from tests.llm.test_operators import DOCS, brute_fingerprint

PAGES = "page_id long, url string, html string"


def side_by_side(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64), np.frombuffer(b"".join(raw), np.uint8)


# ---- common


def test_set_aside_finds_free_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "score int, _own_score int, Spans int")
    away, names = common.set_aside(df, "score", "spans", "__own_score")
    assert not {"score", "spans"} & {c.lower() for c in away.columns} and len(set(map(str.lower, away.columns))) == 3
    assert tuple(away.select(*names).first()) == (1, 2, 3) and away.select(*names).columns == df.columns


def test_no_machine_local_folder_on_a_cluster():
    conf = SimpleNamespace(get=lambda *a: None)
    spark = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(getConf=lambda: conf, master="spark://h:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_folder(spark)


def test_folders_are_freed(spark):
    since = common.mark()
    a, b = common.stored(spark.range(3), "a"), common.stored(spark.range(4), "b")
    common.freed(since, but=1)
    assert b.count() == 4 and common.mark() == since + 1
    with pytest.raises(Exception, match="(?i)exist"):
        a.count()


def test_components_with_hubs(spark, monkeypatch):
    monkeypatch.setattr(common, "HUB", 5)
    edges = [(0, x) for x in range(1, 60)] + [(100 + i, 101 + i) for i in range(12)] + [(59, 100)]
    got = dict(map(tuple, common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert set(got.values()) == {0} and len(got) == 60 + 13


# ---- 1


def test_copies_leave_no_language_out(spark):
    rng = np.random.default_rng(1)
    fr = [("le texte unique est ici et la", "fr")] * 600
    en = [(" ".join(rng.choice(["the", "cat", "sat", "on", "mat", "with", "hat"], 12)) + f" {'abcdefghij'[i % 10]}", "en") for i in range(600)]
    p = language_id.fit(spark.createDataFrame(fr + en, "text string, lang string"), per_language=50)
    assert p.languages == ["en", "fr"]
    with pytest.raises(ValueError, match="more than 1 languages"):
        language_id.fit(spark.createDataFrame(fr + en, "text string, lang string"), most_languages=1)


def test_distance_by_brute_force():
    rng = np.random.default_rng(2)
    ranks = {k: rng.permutation(60)[:20].tolist() for k in ("b", "a", "c")}
    p = language_id.Profiles(ranks, top=20)
    for _ in range(50):
        codes = rng.integers(0, 70, 300)
        mine = [c for c, _ in sorted(Counter(codes.tolist()).items(), key=lambda x: (-x[1], x[0]))[:20]]
        far = {k: sum(abs(r.index(c) - i) if c in r else 20 for i, c in enumerate(mine)) for k, r in ranks.items()}
        best = min(sorted(far), key=far.get)
        assert p.judge(codes) == (best, pytest.approx(max(0, 1 - far[best] / (20 * len(mine)))))


@pytest.mark.parametrize("text", ["日本語のテキスト" * 200, "日" * 500, "é" * 301 + " x " + "本" * 200, "語。" * 300, "𐐀a" * 200])
def test_long_texts_of_any_script(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    values, n = np.unique(language_id.grams(np.array([0, len(raw)]), raw)[0], return_counts=True)
    for piece in (16, 100, 333):
        found, count = language_id.counts_of_long(raw, piece)
        assert found.tolist() == values.tolist() and count.tolist() == n.tolist()


# ---- 2


def test_null_items_as_in_sql(spark, tmp_path):
    passage = " ".join(f"w{i}" for i in range(14))
    docs = [(1, f"before {passage} after"), (2, None), (3, ""), (4, passage.upper()), (5, "short one"), (5, "short one"), (6, "nothing of it " * 5)]
    items = [(None, passage), (None, "short"), (7, passage[: len(passage) // 2 + 20]), (8, None), (8, "one"), (9, "!?")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = decontamination.op2_decontamination(spark, str(tmp_path))
    same(got, decontamination.SQL, str(tmp_path))
    assert {r["doc_id"]: (r["n_hit"], r["n_items"]) for r in got.collect()} == {1: (14, 1), 2: (0, 0), 3: (0, 0), 4: (14, 1), 5: (2, 1), 6: (0, 0)}


def test_windows_are_small_and_long_texts_give_the_same(monkeypatch):
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdé"), rng.integers(1, 7))) for _ in range(60)]
    text = "; ".join(rng.choice(words, 3000))
    items = [(str(i), " ".join(text.split("; ")[k : k + n])) for i, (k, n) in enumerate([(0, 10), (400, 30), (401, 12), (2980, 20), (77, 3), (1500, 1)])]
    w = decontamination.Windows([*items, (None, "xx " * 40)])
    off, raw = side_by_side([text])
    n, spans, found = w.scan(off, raw)
    monkeypatch.setattr(decontamination, "PIECE", 300)
    got = w.scan(off, raw)
    assert len(raw) > decontamination.LONG * 300 and got[0].tolist() == n.tolist() and got[2] == found and {x for s in found.values() for x in s} >= {"0", "1", "2", "3", "4", "5"}
    assert decontamination.merged([s[1:] for s in got[1]]) == decontamination.merged([s[1:] for s in spans])
    long = " ".join(rng.choice(words, 100_000))
    big = pickle.dumps(decontamination.Windows([("a", long)]))
    assert len(big) < 20 * 100_000 + len(long.encode()) + 3 * (1 << 20)


# ---- 3


def brute_shards(rows: list[tuple], n: int) -> list[tuple]:
    """(key, crc, size, shard, slot) of (key, text) rows."""
    full = sorted(((k is not None, k if k is not None else 0), zlib.crc32((x or "").encode()), len((x or "").encode()) + 16) for k, x in rows)
    whole, seen, count, out = sum(r[2] for r in full), 0, Counter(), []
    for (known, k), crc, size in full:
        shard = min(n - 1, (2 * seen + size) * n // (2 * whole))
        out.append((str(k if known else None), crc, size, shard, count[shard]))
        count[shard] += 1
        seen += size
    return sorted(out)


@pytest.mark.parametrize("kind", ["long", "string"])
def test_shards_with_a_hot_key_by_brute_force(spark, kind):
    rng = np.random.default_rng(4)
    rows = [(7, f"copy {i % 5}") for i in range(700)] + [(None, "x" * int(k)) for k in rng.integers(0, 40, 60)] + [(int(k), "é" * int(k % 37)) for k in rng.integers(0, 900, 1200)]
    if kind == "string":
        rows = [(k if k is None else f"k{k}", x) for k, x in rows]
        want = [(str(k) if k is not None else "", x) for k, x in rows]
        order = sorted(((k is not None, k or ""), zlib.crc32(x.encode()), len(x.encode()) + 16) for k, x in rows)
        assert len(want) == len(order)
        whole, seen, count, expect = sum(r[2] for r in order), 0, Counter(), []
        for (known, k), crc, size in order:
            shard = min(8, (2 * seen + size) * 9 // (2 * whole))
            expect.append((k if known else "None", crc, size, shard, count[shard]))
            count[shard] += 1
            seen += size
        expect = sorted(expect)
    else:
        expect = brute_shards(rows, 9)
    df = spark.createDataFrame(rows, f"doc_id {kind}, text string").repartition(3)
    got = sharding.shards(df, 9).collect()
    assert sorted((str(r["doc_id"]), r["text_crc32"], r["size"], r["shard"], r["slot"]) for r in got) == expect
    sized = sharding._sized(df, "text")
    most = sharding._cut(sized, 9, ["doc_id", "_crc", "_size"]).groupBy("_range").count().agg(F.max("count")).first()[0]
    assert most < len(rows) / 3  # the hot key is spread over several ranges


def test_sharded_rows_keep_their_columns(spark):
    df = spark.createDataFrame([(2, "b", "s", 5), (1, "a", "s", 6), (None, None, None, 7)], "doc_id long, text string, source string, slot int")
    got = sharding.sharded(df, 2)
    assert got.columns == ["doc_id", "text", "source", "_own_slot", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert sorted((str(r["doc_id"]), r["text"], r["_own_slot"]) for r in got.collect()) == [("1", "a", 6), ("2", "b", 5), ("None", None, 7)]
    slim = {tuple(r) for r in sharding.shards(df, 2).collect()}
    assert {tuple(r) for r in got.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard").collect()} == slim


# ---- 4


def test_very_large_and_small_numbers_link(spark):
    rows = [(1, [1e200, 1e200, 0.0]), (2, [2e200, 2.1e200, 0.0]), (3, [1e-200, 1.1e-200, 0.0]), (4, [0.0, 0.0, 5e-324]), (5, [0.0, 0.0, 1e308]), (6, [1.0, -1.0, 0.0])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (1, 4), 5: (1, 4), 6: (0, 6)}


def test_pairs_of_blocks_in_tiles(monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 6))
    x[20:40] = x[0] + rng.normal(size=(20, 6)) * 0.1
    perm = [sorted({3, *rng.integers(0, 6, 2).tolist()}) for _ in range(60)]
    n = rng.integers(1, 4, 60)
    side = rng.integers(0, 2, 60)
    table = pa.table({"rid": pa.array(range(60), pa.int64()), "n": pa.array(n, pa.int64()), "vec": pa.array(x.tolist()), "perm": pa.array(perm, pa.list_(pa.int32())), "side": pa.array(side, pa.int32())})
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    for tile in (7, 1024):
        monkeypatch.setattr(embeddings, "TILE", tile)
        for same_block in (True, False):
            part = table if not same_block else table.set_column(4, "side", pa.array(np.zeros(60), pa.int32()))
            got = embeddings._pairs(6, 0.95)((pa.scalar(3), pa.scalar(0), pa.scalar(0 if same_block else 1)), part).to_pylist()
            want, edges = Counter(), set()
            for i in range(60):
                for j in range(i):
                    if u[i] @ u[j] >= 0.95 and min(set(perm[i]) & set(perm[j])) == 3 and (same_block or side[i] != side[j]):
                        want[i] += int(n[j])
                        want[j] += int(n[i])
                        edges.add((i, j))
            assert {r["a"]: r["links"] for r in got if r["b"] is None} == dict(want) and len(edges) > 50
            ends = {v for e in edges for v in e}
            assert {v for r in got if r["b"] is not None for v in (r["a"], r["b"])} == ends


def test_recall_of_planted_pairs_and_clusters(spark):
    rng = np.random.default_rng(6)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    x = unit(np.array([r["embedding"] for r in pq.read_table("/root/testdata/sf0.1/embeddings.parquet").to_pylist()], float))
    x = np.vstack([x, unit(x[:800] + rng.normal(size=(800, x.shape[1])) * 0.15 / math.sqrt(x.shape[1])), unit(np.repeat(x[900:920], 40, 0) + rng.normal(size=(800, x.shape[1])) * 0.1 / math.sqrt(x.shape[1]))])
    true = (x @ x.T >= 0.95).sum(1) - 1
    got = embeddings.near_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).toPandas().set_index("vec_id").n_links
    assert true.sum() > 20_000 and got.sum() >= 0.95 * true.sum() and (got.sort_index().to_numpy() <= true).all()


# ---- 5


@pytest.mark.parametrize("page", ['<body class="no-sidebar"><article><p>t</p></article>', '<body class="has-footer"><article><p>t</p></article>', '<body class="page share-enabled"><main><p>t</p></main>', '<div id="search-results-article"><p>t</p></div>',
                                  '<div class="share"><article><p>t</p></article></div>', "<form><nav>m</nav><main><p>t</p></main></form>", '<article><section class="related-work"><p>t</p></section></article>', '<article><p>t</p></article><div id="comments"><article>c</article></div>',
                                  '<article><header><p>t</p></header></article><header>x</header>', "<main><p>t</p><ul class='share-buttons'><li>x</ul></main>", '<p title="a > b">t</p>', '<div class="site-footer">x</div><p>t</p>'])
def test_names_empty_no_page(spark, page):
    rows = [(1, "https://one.x/1", page)]
    assert html_text.extract(spark.createDataFrame(rows, PAGES)).first()["text"] == "t"


def test_parsing_takes_time_in_proportion():
    n = 40_000
    for page in ("<p x" * n, '<p x="' * n, "<div>" * n + "x" + "</div>" * n, "<h1>" * n, "<div>" * n + "</p>" * n, "<script x" * n, "<!x" * n, "<ul><li>" * n, '<div class="' + "a " * n + '">x', "<p>" + " id =" * n + ">x"):
        began = time.perf_counter()
        html_text.facts(page)
        assert time.perf_counter() - began < 6, page[:20]
    nodes, blocks = html_text.parse("<div>" * 2000 + "x" + "</div>" * 2000 + "<p>y</p>")
    assert [(n.tag, s) for n, s, _ in blocks] == [("div", "x"), ("p", "y")] and max(len(n.path) for n in nodes) <= html_text.LONGEST_PATH


def test_style_tree_by_brute_force(spark):
    rng = np.random.default_rng(7)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 5))
    text = lambda n: " ".join(word() for _ in range(n))
    pages = [(i, f"https://s.x/{i}", f"<body><div class=top><a href=x>{word()}</a> same</div><nav>{word()}</nav><div class=story><h1>{text(4)}</h1>" + "".join(f"<p>{text(int(rng.integers(3, 90)))}</p>" for _ in range(int(rng.integers(1, 9)))) + f"</div>{'<div class=foot>All rights</div>' if i % 4 else ''}</body>") for i in range(24)]
    tree = {r["path"]: r for r in html_text.style_tree(html_text.measured(spark.createDataFrame(pages, PAGES))).collect()}
    styles, feats, shares, ups, priors = defaultdict(Counter), defaultdict(Counter), defaultdict(list), {}, {}
    for _, _, page in pages:
        own, pairs = html_text.facts(page)
        for p, (up, style, share, prior) in own.items():
            styles[p][style] += 1
            shares[p].append(share)
            ups[p], priors[p] = up, min(prior, priors.get(p, 1))
        for p, x in pairs:
            feats[p][x] += 1
    score, pres, cont = {}, {}, {}
    for p, s in styles.items():
        m = sum(s.values())
        share = sum(shares[p]) / m
        entropy = -sum(k / m * math.log(k / m, m) for k in s.values()) if m > 1 else 1
        pres[p] = 1 - (1 - entropy) * (1 - share) if m > 1 else 1
        cont[p] = 1 - sum(math.log(k, m) for k in feats[p].values()) / len(feats[p]) if m > 1 and feats[p] else 1
        score[p] = 0.7 * pres[p] + 0.3 * cont[p]
    assert set(tree) == set(styles)
    for p, r in tree.items():
        m, up = sum(styles[p].values()), ups[p]
        context = score[up] if up is not None and sum(shares[up]) / len(shares[up]) < 0.95 else 0.5
        said = min((score[p] + context) / 2, 0.99) if m >= 4 and (up is None or 2 * m >= sum(styles[up].values())) else 0.5
        assert r["pages"] == m and (r["presentation"], r["content"], r["importance"]) == pytest.approx((pres[p], cont[p], (said + priors[p]) / 2), abs=1e-9), p
    low = {p for p, r in tree.items() if r["importance"] < 0.5}
    assert low == {"/body/div.top", "/body/nav!", "/body/div.foot"}


def test_the_tree_decides(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").where("url like '%//blog.tionsh.example.com/%'")
    one = {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()}
    off = {r["page_id"]: r["text"] for r in html_text.extract(pages, least=0).collect()}
    assert len(one) > 300 and all(off[k] != t and t in off[k] for k, t in one.items())
    bare = F.col("html")
    for old, new in (("<nav>", "<div class=a1>"), ("</nav>", "</div>"), ('<div class="ad">', "<div class=b>"), ("<article>", "<div class=c>"), ("</article>", "</div>"), ("<footer>", "<div class=d>"), ("</footer>", "</div>")):
        bare = F.replace(bare, F.lit(old), F.lit(new))
    assert {r["page_id"]: r["text"] for r in html_text.extract(pages.withColumn("html", bare)).collect()} == one  # by the tree alone


def test_hot_hosts_in_several_tasks(spark, monkeypatch):
    rows = spark.read.parquet(f"{DATA}/pages.parquet").withColumn("url", F.when(F.col("page_id") % 3 == 0, "https://hot.x/").otherwise(F.col("url")))
    one = {tuple(r) for r in html_text.extract(rows).collect()}
    monkeypatch.setattr(html_text, "MOST_HOSTS", -1)
    monkeypatch.setattr(html_text, "HOT_HOST", 3)
    assert {tuple(r) for r in html_text.extract(rows).collect()} == one


# ---- 6


@pytest.fixture(scope="module")
def net():
    rng = np.random.default_rng(8)
    plain = ["".join(rng.choice(list("etaoinsr"), rng.integers(2, 7))) for _ in range(200)]
    texts = [" ".join([*rng.choice(plain, 60), *(["zqxab"] if i % 3 == 0 else [])]) for i in range(90)]
    return gru.trained([t.encode() for t in texts], [int(i % 3 == 0) for i in range(90)]), plain


def test_scores_by_plain_python(net):
    network, plain = net
    p, rng = network.p, np.random.default_rng(9)
    sigmoid = lambda v: 1 / (1 + math.exp(-v))

    def score(window: list[str]) -> float:
        raw = side_by_side([" ".join(window)])
        number, _, known, grams, starts = gru.spelt(*raw)
        bucket, ids, cuts = network.numbered(known, grams, starts)
        vectors = [np.concatenate([p["ew"][bucket[k]], p["ec"][ids[cuts[k] : cuts[k + 1]]].mean(0) if cuts[k + 1] > cuts[k] else np.zeros(gru.DIM)]) for k in range(len(known))]
        h = gru.HIDDEN
        states = {}
        for d, order in (("f", range(len(window))), ("b", range(len(window) - 1, -1, -1))):
            state, out = np.zeros(h), {}
            for t in order:
                g, a = vectors[number[t]] @ p[f"w{d}"] + p[f"b{d}"], state @ p[f"u{d}"]
                z, r = 1 / (1 + np.exp(-(g[:h] + a[:h]))), 1 / (1 + np.exp(-(g[h : 2 * h] + a[h : 2 * h])))
                new = np.tanh(g[2 * h :] + r * a[2 * h :])
                state = z * state + (1 - z) * new
                out[t] = state
            states[d] = out
        both = [np.concatenate([states["f"][t], states["b"][t]]) for t in range(len(window))]
        e = np.array([math.exp(np.tanh(x @ p["wa"] + p["ba"]) @ p["v"]) for x in both])
        return sigmoid(float((e / e.sum()) @ np.array([x @ p["w"] for x in both]) + p["b"][0]))

    for n in (0, 1, 5, 32, 33, 56, 57, 120):
        words = rng.choice([*plain, "zqxab"], n).tolist()
        begins = [0] if n <= 32 else [24 * k for k in range(-(-(n - 32) // 24) + 1)]
        want = max((score(words[k : k + 32]) for k in begins if n), default=0.0)
        assert float(toxicity._best(network, *side_by_side([" ".join(words)]))[0]) == pytest.approx(want, abs=1e-4)


def test_long_texts_have_the_same_windows(net):
    network, plain = net
    rng = np.random.default_rng(10)
    for n in (0, 3, 32, 40, 41, 56, 57, 400, 1001):
        off, raw = side_by_side([", ".join(rng.choice([*plain, "zqxab"], n))])
        whole = float(toxicity._best(network, off, raw)[0])
        assert all(toxicity.best_of_long(network, raw, piece) == pytest.approx(whole, abs=1e-6) for piece in (10, 200, 333, 10_000))


def test_held_out_labels_of_the_driver_table(spark):
    folder = "/root/testdata/sf0.1"
    got = toxicity.op6_toxicity(spark, folder).where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet").where("toxic is not null"), "doc_id").select("score", "toxic").toPandas()
    order = got.score.rank().to_numpy()
    ones = got.toxic.to_numpy() == 1
    auc = (order[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())
    assert len(got) > 500 and auc > 0.93


# ---- 7


def test_null_page_ids_as_in_sql(spark, tmp_path, monkeypatch):
    big, rows = "<p>" + "x" * 200, []
    for k, ids in enumerate([(None, 3, 5), (None, None), (8, 8, 9), (None, 10), (11, 12)]):
        rows += [(i, f"u{k}", big + str(k)) for i in ids]
    rows += [(None, None, None), (20, "u", "short"), (21, "u", "short")]
    spark.createDataFrame(rows, PAGES).write.parquet(f"{tmp_path}/pages.parquet")
    same(warc.op7_warc(spark, str(tmp_path)), warc.SQL, str(tmp_path))
    monkeypatch.setattr(warc, "MOST_SHARED", -1)
    monkeypatch.setattr(warc, "HOT", 2)
    same(warc.op7_warc(spark, str(tmp_path)), warc.SQL, str(tmp_path))
    heads = [r["value"] for r in spark.read.text(warc.archive(warc.chunks(warc.originals(spark.createDataFrame(rows[:1], PAGES)))), wholetext=True).collect()]
    assert any(f"Content-Type: application/http; msgtype=response\r\nContent-Length: {204 + len(warc.HTTP)}\r\n\r\n{warc.HTTP}<p>x" in h for h in heads)


def _record(kind, name, block, *more):
    return b"\r\n".join([b"WARC/1.0", b"warc-type:  " + kind, b"WARC-Record-ID: <" + name + b">", *more, b"CONTENT-LENGTH: %d" % len(block), b"", block]) + b"\r\n\r\n"


def test_warc_archives_of_other_origin(spark, tmp_path):
    """Framed by Content-Length: bytes that are no text, blocks that look like records, large blocks in parts, several files."""
    http, typed = b"HTTP/1.0 200 OK\r\nX: y\r\n\r\n", b"Content-Type: application/http;msgtype=response"
    bodies = {b"a": bytes(range(256)) * 40, b"b": b"\r\n\r\nWARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 9, b"c": b"", b"d": b"\n" * 5000, b"e": "né\r".encode() * 3000}
    records = [_record(b"warcinfo", b"i", b"software: x\r\n"), *[_record(b"response", k, http + v, typed) for k, v in bodies.items()], _record(b"request", b"q", b"GET / HTTP/1.0\r\n\r\n", typed),
               _record(b"response", b"raw", b"HTTP/ in prose", b"Content-Type: text/plain")]
    os.makedirs(tmp_path / "w")
    (tmp_path / "w" / "one.warc").write_bytes(b"".join(records[:4]))
    (tmp_path / "w" / "two.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records[4:]))
    (tmp_path / "w" / "none.warc").write_bytes(b"")
    bodies[b"raw"] = b"HTTP/ in prose"
    want = {(f"<{k.decode()}>", len(v), hashlib.sha256(v).hexdigest(), "response") for k, v in bodies.items()}
    for most in (warc.CHUNK, 1000):
        got = warc.digests(warc.records(spark, f"file://{tmp_path}/w", most)).collect()
        assert len(got) == len(want) and {(r["record_id"], r["payload_bytes"], r["payload_digest"], r["record_type"]) for r in got} == want
    parts = warc.framed(spark, f"file://{tmp_path}/w", 1000).collect()
    assert max(len(r["data"]) for r in parts) == 1000
    assert sum(len(r["data"]) for r in parts) == sum(len(v) for v in bodies.values()) + 5 * len(http) + len(b"software: x\r\n") + len(b"GET / HTTP/1.0\r\n\r\n")


def test_warc_streams_cut_at_any_place():
    whole = _record(b"response", b"a", b"x" * 2500) + _record(b"response", b"b", b"") + _record(b"response", b"c", b"\r\n")
    want = [(0, 1500, b"x" * 1000), (1, 500, b"x" * 1000), (2, 0, b"x" * 500), (0, 0, b""), (0, 0, b"\r\n")]
    for step in (1, 7, 1000, 10_000):
        frames, got = warc._Frames(1000), []
        for at in range(0, len(whole), step):
            got += frames.feed(whole[at : at + step])
        got += frames.feed(b"", last=True)
        assert [(p, rest, data) for _, p, rest, _, data in got] == want
    frames = warc._Frames(1000)
    got = [*frames.feed(whole[:1600]), *frames.feed(b"", last=True)]
    assert sum(len(g[4]) for g in got) + got[-1][2] == 2500 and got[-1][2] > 0  # an early end: how much is missing
    for bad in (b"<html>", whole[:20], b"WARC/1.0\r\nWARC-Type: x\r\n\r\n"):
        frames = warc._Frames(1000)
        with pytest.raises(ValueError):
            [*frames.feed(bad), *frames.feed(b"", last=True)]


def test_warc_is_one_gzip_member_a_record(spark, monkeypatch):
    """Each record starts a member, so a reader can seek; chunks don't part characters; long records are several members."""
    bodies = ["é漢😀" * 400, "p" * 50, "q" * 5000]
    pages = spark.createDataFrame([(i, "u", b) for i, b in enumerate(bodies)], PAGES).coalesce(1)
    table = warc.chunks(warc.originals(pages), chunk=100)
    for r in table.collect():
        assert len(r["data"].encode()) <= 103 and "\ufffd" not in r["data"]
    folder = warc.archive(table).removeprefix("file://")
    data = b"".join(open(f"{folder}/{f}", "rb").read() for f in sorted(os.listdir(folder)) if f.endswith(".warc.gz"))
    members = 0
    while data:
        one = zlib.decompressobj(31)
        text = one.decompress(data)
        assert text.startswith(b"WARC/1.1\r\n") and one.eof
        data, members = one.unused_data, members + 1
    assert members == table.count() > 80
    small = [pa.RecordBatch.from_arrays([pa.array(["r" * 1000, "", "s"])], ["value"])]
    monkeypatch.setattr(warc, "MEMBER", 64)
    out = [v for b in warc._members(iter(small)) for v in b.column(0).to_pylist()]
    assert gzip.decompress(b"".join(v + b"\0" for v in out)) == b"r" * 1000 + b"s" and len(out) == 17


# ---- 8


def test_hashes_as_the_library():
    rng = np.random.default_rng(11)
    data = rng.integers(0, 256, 4000).astype(np.uint8)
    start, size = rng.integers(0, 3300, 2000), rng.integers(0, 700, 2000)
    assert [int(h) for h in xxh.xxh64(data, start, size, 42)] == [xxhash.xxh64_intdigest(data[a : a + n].tobytes(), 42) for a, n in zip(start, size)]


def test_fingerprints_in_pieces():
    rng = np.random.default_rng(12)
    texts = ["", " ", "a", "A b", " a  b\tc ", "a b c D", "a b c d e f\n", "é" * 700 + " x y z w", "\x0b\x0c", "x\x00y z w v"] + [" ".join(rng.choice(["Aa", "b", "ccc d", "dd"], n)) for n in (5, 300, 3000)]
    off, raw = side_by_side(texts)
    want = [brute_fingerprint(t) for t in texts]
    assert [int(f) for f in simhash._voted(*simhash._votes(off, raw, 4))] == want
    assert all(simhash.fingerprint(t.encode(), piece=k) == f for t, f in zip(texts, want) for k in (3, 40, 500, 1 << 20))


def test_one_of_each_with_a_hot_id(spark):
    rows = [(5, "the same text again and again", "en", "s", i) for i in range(400)] + [(i, f"another text number {'x' * (i % 7)} {i * 7919}", "en", "s", 1) for i in range(600, 640)] + [(None, None, "en", "s", 1)] * 3
    got = simhash.deduplicated(spark.createDataFrame(rows, DOCS).repartition(4))
    ids = [r["doc_id"] for r in got.collect()]
    assert ids.count(5) == 1 and ids.count(None) == 1 and len(set(ids)) == len(ids)


# ---- 9


def test_long_pre_tokens_and_texts(spark, monkeypatch):
    trie = token_counts.Trie(token_counts.pieces())
    words = ["日本語" * 40, "abc" * 90, "tokenization" * 30, "é🙂" * 60]
    want = [trie[w.encode()] for w in words]
    held = len(trie.best)
    assert [trie.long(w.encode()) for w in words] == want and len(trie.best) == held
    assert trie[b"ab" * 5000] > 0 and len(trie.best) == held  # not stored
    monkeypatch.setattr(token_counts, "PIECE", 50)
    text = " ".join(words) + " \t " + " ".join(words)
    assert [w for part in token_counts._spans(text.encode()) for w in part.split()] == text.encode().split()


# ---- 10


def test_targets_by_filling_up(spark):
    rng = np.random.default_rng(13)
    for n in (1, 2, 5, 17):
        sizes = {f"s{i:02d}": int(x) for i, x in enumerate(rng.integers(0, 1000, n) ** 2)}
        weight = {s: [1, 2, 3][i % 3] for i, s in enumerate(sorted(sizes))}
        target, open_, left = {}, set(sizes), float(sum(sizes.values()))
        while open_:  # those above their cap stop there; the rest is shared again
            share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
            above = [s for s in open_ if share[s] > 3 * sizes[s] + 1e-9]
            if not above:
                target |= share
                break
            for s in above:
                target[s] = 3.0 * sizes[s]
                left -= target[s]
                open_.remove(s)
        got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
        assert got == pytest.approx(target, rel=1e-9, abs=1e-6)


def test_rounding_by_brute_force(spark):
    """Pairs of a group in its order, by the rule as it is told: mass moves one way or the other until one unit is empty or full."""
    rng = np.random.default_rng(14)
    rows = [(int(b), f"s{s}", float(m), float(m + r), float(u)) for b, s, m, r, u in zip(np.sort(rng.integers(0, 6, 200)), rng.integers(0, 3, 200), rng.integers(0, 9, 200), rng.integers(0, 9, 200), rng.random(200))]
    rows.sort(key=lambda x: (x[0], x[1]))
    import pandas as pd

    frame = pd.DataFrame(rows, columns=["bucket", "source", "mass", "cap", "u"])
    for last in (False, True):
        out = pd.concat(list(mixing._pairing(last)(iter([frame.iloc[:70], frame.iloc[70:75], frame.iloc[75:]]))))
        assert len(out) == len(frame)
        for key, own in out.groupby(["bucket", "source"]):
            before = frame[(frame.bucket == key[0]) & (frame.source == key[1])]
            inner = own[(own.mass > 0) & (own.mass < own.cap)]
            assert len(inner) <= (0 if last else 1) and sorted(own.cap) == sorted(before.cap) and (inner.open if len(inner) else pd.Series([True])).all()
            if not last:
                assert own.mass.sum() == pytest.approx(before.mass.sum())
            else:
                assert abs(own.mass.sum() - before.mass.sum()) <= before.cap.max() / 2 + 1e-9


def test_many_sources_give_the_same_mix(spark, monkeypatch):
    rows = [(i, "w " * (i % 13), "en", None if i % 11 == 0 else "hot" if i % 3 else f"s{i % 7}", 1) for i in range(300)]
    df = spark.createDataFrame(rows, DOCS)
    one = sorted(map(str, mixing.copies(df).collect()))
    monkeypatch.setattr(mixing, "MOST_SOURCES", -1)
    assert sorted(map(str, mixing.copies(df).collect())) == one
