import random

import pytest
import xxhash
from helpers import DOC_SCHEMA, awkward, clashing, empty, prose, words_of
from pyspark.sql import functions as F

from freightlake.llm import simhash


def brute_fingerprint(text):
    w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in words_of(text)]
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute(rows, prints, radius=4):
    """Component of each row by comparing all pairs of fingerprints."""
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    each = sorted(root)
    for i, a in enumerate(each):
        for b in each[:i]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    least = {}
    for (i, _), p in zip(rows, prints, strict=True):
        if i is not None:
            least[find(p)] = min(i, least.get(find(p), i))
    return sorted(((i, f"{p:016x}", least.get(find(p))) for (i, _), p in zip(rows, prints, strict=True)), key=str)


def check(df, **more):
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = sorted(map(tuple, simhash.near_duplicates(df, **more).collect()), key=str)
    assert got == brute(rows, [brute_fingerprint(t) for _, t in rows])


def test_awkward_rows_and_near_copies(spark):
    draw = random.Random(4)
    texts = ["KK Iİ ÀB c d", "one", "One two", "a b c", "a b c d", "A  b\tc\nd"]
    for g in range(5):
        w = prose(120 + 60 * g, g).split()
        texts.append(" ".join(w))
        for n in range(1, 9):
            edited = list(w)
            for k in draw.sample(range(len(w)), n):
                edited[k] = f"e{draw.randrange(10**9)}"
            texts.append(" ".join(edited))
    df = spark.createDataFrame([(100 + i, t, "en", "s", 0) for i, t in enumerate(texts)], DOC_SCHEMA)
    df = df.unionByName(awkward(spark)).unionByName(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    check(clashing(df, "id", "fp", "least", "key"))


def test_links_of_crowded_and_cool_buckets(spark):
    """Fingerprints around a few centres: as pairs of buckets and by midpoints."""
    draw = random.Random(7)
    prints = {0, (1 << 64) - 1}
    for _ in range(6):
        centre = draw.getrandbits(64)
        for _ in range(60):
            x = centre
            for b in draw.sample(range(64), draw.randrange(0, 7)):
                x ^= 1 << b
            prints.add(x)
    prints |= {draw.getrandbits(64) for _ in range(100)}
    each = sorted(prints)
    df = spark.createDataFrame([(simhash.signed(p),) for p in each], "fp long")
    rows = [(i, None) for i in range(len(each))]
    want = brute(rows, each)
    for hot in (0, 3, 10**6):
        found = [(r.a, r.b) for r in simhash.links(df, hot=hot).collect()]
        assert all(((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4 and a < b for a, b in found)
        root = {simhash.signed(p): simhash.signed(p) for p in each}

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in found:
            root[find(a)] = find(b)
        least = {}
        for i, p in enumerate(each):
            least.setdefault(find(simhash.signed(p)), i)
        assert sorted(((i, f"{p:016x}", least[find(simhash.signed(p))]) for i, p in enumerate(each)), key=str) == want


def test_tables_of_masks_are_not_broadcast(spark, monkeypatch):
    """16,000 fingerprints have 496,000 rows in tables, and 240,000 or so in buckets."""
    rows = spark.range(8000).select(F.explode(F.array("id", F.col("id") + 8000)).alias("id"))
    bit = F.when(F.col("id") < 8000, F.lit(0).cast("long")).otherwise(F.lit(1 << 40))
    rows = rows.select("id", F.xxhash64(F.col("id") % 8000).bitwiseXOR(bit).alias("fp"))
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, *_: docs)
    limit = "spark.sql.maxBroadcastTableSize"
    spark.conf.set(limit, "4m")
    try:
        got = {r.id: r.component_id for r in simhash.near_duplicates(rows, "id").collect()}
    finally:
        spark.conf.unset(limit)
    assert got == {i: i % 8000 for i in range(16000)}


def test_masks_cover_every_pair_within_the_radius():
    for radius in (2, 4):
        each = simhash.masks(radius)
        assert len(each) == 2 ** (radius + 1) - 1 and all(28 <= m.bit_count() <= 46 for m in each)
        draw = random.Random(radius)
        for _ in range(3000):
            differ = sum(1 << b for b in draw.sample(range(64), draw.randrange(1, radius + 1)))
            assert any(differ & m == 0 for m in each)
    assert len(simhash.ball(2)) == 2081


def test_long_texts_are_hashed_in_slices(monkeypatch):
    text = prose(500, 3).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "SLICE", 7)
    assert simhash.fingerprint(text) == whole == brute_fingerprint(text.decode())


def test_empty_table_and_odd_radius(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0
    with pytest.raises(ValueError, match="even"):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), radius=3)
