import random

import numpy as np
from helpers import DOC_SCHEMA, awkward, brute_components, clashing, empty, prose

from freightlake.llm import minhash
from freightlake.llm.components import components


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOC_SCHEMA)


def edited(text, n, draw):
    w = text.split()
    for k in draw.sample(range(len(w)), n):
        w[k] = f"edit{draw.randrange(10**9)}"
    return " ".join(w)


def check(df, words, threshold):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    roots, sets = brute_components(rows, words, threshold)
    least = {}
    for (i, _), root in zip(rows, roots, strict=True):
        if i is not None:
            least[root] = min(i, least.get(root, i))
    want = sorted(((i, len(s), least.get(r) if s else i) for (i, _), s, r in zip(rows, sets, roots, strict=True)), key=str)
    got = minhash.near_duplicates(df, words=words, threshold=threshold).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_chains_groups_and_borderline_pairs(spark):
    draw = random.Random(5)
    texts = []
    for g in range(6):
        base = prose(150 + 40 * g, g)
        texts += [base, base, base.upper(), base.replace(" ", "\n ")]
        now = base
        for step in range(5):  # a chain: neighbours are linked, ends may not be
            now = edited(now, 2 + g % 3, draw)
            texts.append(now)
        texts += [edited(base, n, draw) for n in range(1, 14)]  # around the threshold
    texts += [prose(n, 99) for n in range(1, 9)] + ["a b", "A  b", "a b c", "a", "a"]
    df = docs(spark, texts)
    check(df, 3, 85)
    check(df, 5, 80)


def test_many_near_copies_of_one_text(spark):
    draw = random.Random(8)
    base = prose(120, 1)
    check(docs(spark, [edited(base, 1 + i % 5, draw) for i in range(150)] + [prose(100, 50 + i) for i in range(20)]), 3, 85)


def test_awkward_rows(spark):
    check(awkward(spark), 3, 85)
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), 5, 80)
    assert minhash.near_duplicates(empty(spark)).count() == 0


def test_one_of_each_group_stays(spark):
    df = clashing(awkward(spark), "id", "t1", "component", "__row", "keys")
    out = minhash.keep_one(df)
    assert out.columns == df.columns
    texts = [r.text for r in out.collect()]
    assert sum("the old harbour" in (t or "") for t in texts) == 1
    assert texts.count(None) == 3 and texts.count("") == 1  # no set: nothing to link
    assert min(r.doc_id for r in out.where("text like 'the old harbour%'").collect()) == 1
    assert minhash.keep_one(empty(spark)).count() == 0


def test_bands_miss_less_than_promised():
    for threshold in (80, 85, 90, 95):
        bands, rows = minhash.bands_for(threshold)
        assert (1 - (threshold / 100) ** rows) ** bands <= minhash.MISS


def test_sketches_estimate_high_similarities():
    draw = np.random.default_rng(1)
    signer = minhash.Signer(35, 6)
    errors = []
    for share in (0.85, 0.9, 0.95):
        for _ in range(40):
            common = draw.integers(0, 1 << 63, int(400 * share), dtype=np.uint64)
            own = [draw.integers(0, 1 << 63, int(200 * (1 - share)), dtype=np.uint64) for _ in range(2)]
            a, b = (np.unique(np.concatenate((common, x))) for x in own)
            j = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            s = signer.sketches(np.stack([signer.samples(a), signer.samples(b)]))
            differ = int(np.unpackbits((s[0] ^ s[1]).view(np.uint8)).sum())
            assert differ <= minhash.most_bits(85, 210) or j < 0.85
            errors.append(1 + 512 / (4 * 210) * np.log(1 - 2 * differ / 512) - j)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.04


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 100), (300, 300)] + [(400, 400 + i) for i in range(1, 50)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.component for r in components(df, "a", "b").collect()}
    assert {found[i] for i in range(61)} == {0} and found[200] == 100 and 300 not in found
    assert {found[400 + i] for i in range(50)} == {400} and len(found) == 61 + 2 + 50
