import numpy as np
from helpers import awkward, clashing, empty
from pyspark.sql import functions as F

from freightlake.llm import byte_cnn, toxicity, url_filter

SF = "/root/testdata/sf0.1"


def auc(labels, scores):
    labels, rank = np.array(labels), np.argsort(np.argsort(scores)) + 1
    n1 = labels.sum()
    return (rank[labels == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(labels) - n1))


def held_out(spark, found, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = found.join(labels, "doc_id").where("held_out").select(label, "score", "predicted").collect()
    return [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows]


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    y, s, p = held_out(spark, toxicity.toxicity(docs, labels), "toxic")
    caught = [b for a, b in zip(y, p, strict=True) if a == 1]
    clean = [b for a, b in zip(y, p, strict=True) if a == 0]
    assert auc(y, s) > 0.95 and sum(caught) / len(caught) > 0.75 and sum(clean) / len(clean) < 0.01


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    y, s, p = held_out(spark, byte_cnn.quality(docs, labels), "quality")
    good = [b for a, b in zip(y, p, strict=True) if a == 1]
    bad = [b for a, b in zip(y, p, strict=True) if a == 0]
    assert auc(y, s) > 0.97 and sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.2


def test_held_out_rows_are_never_learned_from(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    wrong = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("toxic"))
                              .otherwise(F.col("toxic")).cast("int"))
    a = {r.doc_id: r.score for r in toxicity.toxicity(docs, labels).collect()}
    assert a == {r.doc_id: r.score for r in toxicity.toxicity(docs, wrong).collect()}


def test_awkward_rows_labels_and_empty_tables(spark):
    df = clashing(awkward(spark), "score", "held_out", "label", "order")
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (2, 0, 0), (3, 1, 0), (6, None, None), (None, 1, 1), (8, 1, 1), (9, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    for run in (toxicity.toxicity, byte_cnn.quality):
        for known in (labels, labels.where("doc_id < 0"), labels.where("doc_id = 3")):
            rows = run(df, known).collect()
            assert len(rows) == df.count() and all(0 <= r.score <= 1 for r in rows)
            assert all(r.held_out is False for r in rows if r.doc_id is None)
        same = {r.score for r in run(df, labels).collect() if r.doc_id in (1, 2)}
        assert len(same) == 1
        assert run(empty(spark), labels).count() == 0


def test_network_gradients():
    draw = np.random.default_rng(2)
    model = {k: v.astype(np.float64) for k, v in byte_cnn.initial().items()}
    raw = byte_cnn.padded("".join(chr(draw.integers(32, 127)) for _ in range(900)))
    grads = {k: np.zeros_like(v) for k, v in model.items()}
    byte_cnn.gradients(model, raw, 1, grads)
    text = bytes(raw).decode()

    def loss(m):
        return -np.log(byte_cnn.probability(m, text))

    for name in model:
        flat = np.flatnonzero(np.abs(grads[name].ravel()) > 1e-4)[:5]
        for at in flat:
            up, down = ({**model, name: model[name].copy()} for _ in range(2))
            up[name].ravel()[at] += 1e-5
            down[name].ravel()[at] -= 1e-5
            slope = (loss(up) - loss(down)) / 2e-5
            assert abs(slope - grads[name].ravel()[at]) < 1e-3 + 0.01 * abs(slope), name


def test_pieces_of_a_long_text_give_the_same(monkeypatch):
    model = byte_cnn.initial()
    text = "".join(chr(32 + (i * i) % 90) for i in range(10_000))
    whole = byte_cnn.probability(model, text)
    monkeypatch.setattr(byte_cnn, "PIECE", byte_cnn.STRIDE * byte_cnn.BLOCK * 4)
    assert abs(byte_cnn.probability(model, text) - whole) < 1e-6


def test_ftrl_weights_are_sparse_and_rates_are_per_place():
    model = toxicity.Ftrl(4, l1=1.0)
    for _ in range(200):
        model.learn(np.array([0, 3]), 1)
        model.learn(np.array([1, 3]), 0)
    w = model.weights(np.arange(4))
    assert w[0] > 0 > w[1] and w[2] == 0 and model.n[3] > model.n[0]


def brute_rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest.split("/")[0].split("?")[0].split("#")[0]
    path = rest[len(host):].split("?")[0].split("#")[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


def test_url_rules_by_brute_force(spark):
    urls = ["http://www.EXAMPLE.com/en/1?x=1#f", "https://example.com/en", "https://a.b.example.com/en/", "http://xexample.com/en/1",
            "http://com", "http://com/", "http://a.net/es/", "http://a.net/ES/", "http://net/fr/x?y=/es/", "ftp://host?q://x/y", "no scheme",
            "", None, "http://", "x://y://com/z", "http://example.org/en/1", "http://com#/", "HTTP://É.com/ä", "http://a.com?/x"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").unionByName(
        spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select((F.col("page_id") + 1000).alias("page_id"), "url"))
    given = {r.page_id: r.url for r in pages.collect()}
    rows = url_filter.judge(pages).collect()
    assert len(rows) == len(given)
    for r in rows:
        host, path, rule, verdict = brute_rule(given[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.score >= url_filter.CUT else "allow"))


def test_trees_judge_by_the_urls_text(spark):
    """Labels that depend on the text are learned, on URLs never seen; a whole rule left
    out of the training is scored by several features, not by what the rules test."""
    made = spark.range(4000).select(
        F.concat(F.lit("http://h"), F.col("id") % 97, F.when(F.col("id") % 3 == 0, ".org/").otherwise(".info/"),
                 F.when(F.xxhash64("id") % 2 == 0, F.concat(F.lit("a/b/c?x="), F.md5(F.col("id").cast("string"))))
                 .otherwise(F.concat(F.lit("page/"), F.col("id") % 500))).alias("url"),
        (F.xxhash64("id") % 2 == 0).cast("int").alias("label"))
    part = F.pmod(F.xxhash64("url"), F.lit(4))
    model = url_filter.UrlModel(made.where(part > 0), made, "url")
    rows = model.score(url_filter.lexical(made.where(part == 0), "url")).select("label", "score").collect()
    assert np.mean([(r.score >= 0.5) == (r.label == 1) for r in rows]) > 0.95

    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("url")
    left_out = [r for r in url_filter.RULES if r[1:] != ("net", "/fr/")]
    model = url_filter.UrlModel(url_filter.by_rules(pages, "url", left_out), pages, "url")
    importance = model.trees.featureImportances.toArray()
    assert (importance > 0).sum() >= 4 and importance.max() < 0.9
    free = url_filter.lexical(pages.join(url_filter.by_rules(pages, "url"), "url", "left_anti"), "url")
    assert model.score(free).select(F.round("score", 6)).distinct().count() > 10


def test_url_statistics_count_all_rows_and_the_sample_distinct_urls(spark):
    hot = spark.range(300).select(F.lit("http://hot.example/a/1").alias("url"), F.lit(1).alias("label"))
    few = spark.createDataFrame([(f"http://h{i}.s{i % 50}/g{i % 40}/x", i % 2) for i in range(200)], "url string, label int")
    known = hot.unionByName(few)
    hosts, suffixes = url_filter.host_statistics(known.select("url"), "url")
    want = {"example": (300, 1)} | {f"s{k}": (4, 4) for k in range(50)}
    assert {r.suffix: (round(np.expm1(r.suffix_urls)), round(np.expm1(r.suffix_hosts))) for r in suffixes.collect()} == want
    assert {round(np.expm1(r.host_paths)) for r in hosts.collect()} == {1} and hosts.count() == 201
    assert url_filter.UrlModel(known, known, "url", rows=40).trees is not None
    for distinct in (0, 201):
        sample = url_filter.url_sample(known, "url", 40, distinct).collect()
        want = known.select(F.xxhash64(F.lit("sample"), "url").alias("h"), "url").distinct().orderBy("h").limit(40).collect()
        assert [r.url for r in sample] == [r.url for r in want]


def test_very_long_urls(spark):
    long = "http://h.org/" + "a/" * 50_000 + "?" + "&".join(f"k{i}=1" for i in range(20_000))
    pages = spark.createDataFrame([(1, long), (2, "http://" + "h." * 30_000 + "com/x"), (3, "http://a.net/es/" + "é" * 100_000)],
                                  "page_id long, url string")
    rows = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(pages).collect()}
    assert rows[2] == ("com/", "allow") and rows[3] == ("net/es/", "block") and rows[1][0] is None


def test_url_edge_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.org/x"), (1, "http://a.org/x"), (None, None)], "page_id long, url string")
    extra = pages.withColumn("host", F.lit(1)).withColumn("score", F.lit(2))
    assert [r.verdict for r in url_filter.judge(extra).collect()] == ["allow"] * 3  # nothing labelled: no block seen
    assert url_filter.judge(pages.where("page_id < 0")).count() == 0
    entropy = spark.createDataFrame([("aabb",), ("",), ("abcd",)], "t string").select(url_filter.entropy(F.col("t"))).collect()
    assert [round(r[0], 6) for r in entropy] == [1.0, 0.0, 2.0]


def test_long_texts_are_learned_from_in_pieces(spark):
    text = "".join(chr(97 + i * i % 26) for i in range(1000))
    sample = spark.createDataFrame([(5, 1, text), (6, 0, "short"), (7, 0, ""), (8, 1, "x" * 80)], "order long, label int, text string")
    rows = byte_cnn.examples(sample, chars=80, rows=100).collect()
    own = [r.text for r in rows if r.label == 1 and "x" * 80 != r.text]
    assert sorted(own) == sorted(text[at:at + 80] for at in range(0, 990, 70)) and {r.text for r in rows} >= {"short", "", "x" * 80}
    few = byte_cnn.examples(sample, chars=80, rows=6).collect()
    assert len(few) == 6 and {(r.order, r.text) for r in few} <= {(r.order, r.text) for r in rows}


def test_probability_equals_a_plain_convolution():
    draw = np.random.default_rng(4)
    model = byte_cnn.initial()
    for n in (0, 3, 8, 127, 500, 1700):
        text = "".join(chr(draw.integers(32, 127)) for _ in range(n))
        raw = list(text.encode()) + [0] * max(0, 8 - n)
        z = np.array([np.maximum(0, sum(model["embed"][raw[i + k]] @ model["filters"][8 * k:8 * k + 8] for k in range(8)) + model["shift"])
                      for i in range(len(raw) - 7)])
        chunks = np.array([z[s:s + 512].max(0) for s in byte_cnn.chunk_starts(len(z))])
        x = chunks.mean(0) @ model["mean"] + chunks.max(0) @ model["top"] + model["bias"][0]
        assert abs(byte_cnn.probability(model, text) - 1 / (1 + np.exp(-x))) < 1e-5


def test_toxicity_equals_a_plain_version(spark):
    """The whole operator by dictionaries: features, the order of the sample, FTRL, scores."""
    rows = [(i, " ".join(["bad" if i % 3 == 0 and j % 4 == 0 else f"w{(i * 7 + j) % 30}" for j in range(12)])) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int")
    orders = {r.doc_id: (r.o, r.f) for r in docs.select(
        "doc_id", F.xxhash64(F.lit("sample"), "doc_id").alias("o"), (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4).alias("f")).collect()}
    hashes = toxicity.TextHashes()
    places = {i: sorted(set(toxicity.features(t, hashes).tolist())) + ["bias"] for i, t in rows}
    z, n = {}, {}

    def weight(k):
        v = z.get(k, 0.0)
        return 0.0 if abs(v) <= 6.0 else (np.sign(v) * 6.0 - v) / ((1 + np.sqrt(n.get(k, 0.0))) / 2.0 + 0.5)

    for _ in range(toxicity.PASSES):
        for i, _t in sorted(rows, key=lambda r: orders[r[0]][0]):
            if orders[i][1] == 2:
                continue
            w = {k: weight(k) for k in places[i]}
            g = 1 / (1 + np.exp(-sum(w.values()))) - (i % 3 == 0)
            for k in places[i]:
                old = n.get(k, 0.0)
                z[k] = z.get(k, 0.0) + g - (np.sqrt(old + g * g) - np.sqrt(old)) / 2.0 * w[k]
                n[k] = old + g * g
    got = {r.doc_id: (r.held_out, r.score) for r in toxicity.toxicity(docs, labels).collect()}
    for i, _t in rows:
        want = 1 / (1 + np.exp(-sum(weight(k) for k in places[i])))
        assert got[i][0] == (orders[i][1] == 2) and abs(got[i][1] - want) < 1e-9
