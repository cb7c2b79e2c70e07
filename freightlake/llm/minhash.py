"""Near-duplicate texts by MinHash, banding and odd sketches.

A document's set is that of its distinct word shingles (A-Z lower-cased; with
fewer words, the whole sequence).  Documents with equal sets are one class.  For
each class the MinHash samples give band keys and an odd sketch: each sample
flips one bit of a bitmap, so the bits that differ between two bitmaps (their
XOR's population count) tell how many samples differ; at high similarity that
estimate is precise.  Classes that share a band are candidates; the sketches
drop candidates that are far from the threshold; what is left is confirmed on
the full sets.

Bands are chosen so that a pair at the threshold is missed with a probability
below ``MISS``; the sketch's own cut lies 6 standard deviations away.

Links are wanted for their connected components, so not all pairs of a bucket
are emitted: first each member is paired with the bucket's smallest class, and
linked classes get their component.  In buckets that still hold several
components each member is then paired with the class that has the fewest
shingles of its own (the middle of a group of edited copies).  What still holds
several components after that has all its pairs of different components
compared that sizes, own shingles and sketches let through.  A pair inside one
component cannot change it, so no link that matters is left out.

Defined results: texts without words, empty or NULL have no set: size 0, linked
with nothing, their own component.  The component of a document is its smallest
id; NULL ids do not count as smallest, a component of NULL ids has a NULL id.
Repeated rows and equal ids are rows of their own, in one component if their
sets are equal.  An empty table gives an empty result; other columns are not
read unless named.

At scale: signatures are about 350 bytes a document, written once; copies are
one class before any join (counted map-side); buckets are joined, not grouped,
so a hot bucket is split by the adaptive skew join; full sets are built only
for classes that have a candidate left.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightlake.llm.common import if_small, python_workers, stage
from freightlake.llm.components import components, labels

MISS = 1e-7
SKETCH_LONGS = 8  # 512 bits
MASK = (1 << 64) - 1


def bands_for(threshold: int) -> tuple[int, int]:
    """(bands, rows) for a similarity in per cent: the most rows of up to 6 for
    which at most 48 bands miss less than MISS."""
    s = threshold / 100
    for rows in range(6, 0, -1):
        bands = math.ceil(math.log(MISS) / math.log1p(-s ** rows))
        if bands <= 48:
            return bands, rows
    raise ValueError("similarity too low for banding")


def most_bits(threshold: int, samples: int) -> int:
    """The greatest population count that a linked pair may show: the mean at
    the threshold and six standard deviations.

    x flips leave n/2 (1 - e^(-2x/n)) of n bits set; each differing sample makes
    two flips.  The spread comes from the samples and from flips that meet.
    """
    n, d = 64 * SKETCH_LONGS, 1 - threshold / 100
    x = 2 * samples * d
    fade = math.exp(-2 * x / n)
    meet = n / 4 * (1 - fade ** 2) - x * fade ** 2
    drawn = samples * d * (1 - d) * (2 * fade) ** 2
    return math.ceil(n / 2 * (1 - fade) + 6 * math.sqrt(meet + drawn))


# -- signatures, inside tasks ----------------------------------------------------

def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift rounds)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hash of each word; emptied when it grows large."""

    def __missing__(self, word: bytes) -> int:
        h = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(self) < 500_000:
            self[word] = h
        return h


def shingle_set(text: str | None, words: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    found = (text or "").encode().lower().split()  # bytes: only A-Z, only ASCII white space
    if not found:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, found), dtype=np.uint64, count=len(found))
    k = min(words, len(w))
    h = np.full(len(w) - k + 1, np.uint64(k), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + w[j:j + len(h)])
    return np.unique(h)


class Signer:
    def __init__(self, bands: int, rows: int):
        self.bands, self.rows = bands, rows
        draw = np.random.default_rng(20_240_229)
        n = bands * rows
        self.a = (draw.integers(0, 1 << 32, n, dtype=np.uint64) | 1).astype(np.uint32)[:, None]
        self.b = draw.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)[:, None]
        self.seed = draw.integers(0, 1 << 63, n, dtype=np.uint64)

    def samples(self, shingles: np.ndarray) -> np.ndarray:
        """The least value of each of the hash functions, over blocks of the set."""
        x = (shingles >> np.uint64(32)).astype(np.uint32)
        out = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        with np.errstate(over="ignore"):
            for at in range(0, len(x), 1024):
                np.minimum(out, (x[None, at:at + 1024] * self.a + self.b).min(axis=1), out=out)
        return out

    def band_keys(self, samples: np.ndarray) -> np.ndarray:
        """(documents, bands) of 64-bit keys, different from band to band."""
        parts = samples.reshape(len(samples), self.bands, self.rows).astype(np.uint64)
        h = np.broadcast_to(np.arange(self.bands, dtype=np.uint64) + np.uint64(1), parts.shape[:2])
        with np.errstate(over="ignore"):
            for j in range(self.rows):
                h = _mix(h * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j])
        return h.view(np.int64)

    def sketches(self, samples: np.ndarray) -> np.ndarray:
        """(documents, longs): parity bitmaps of the samples."""
        bits = 64 * SKETCH_LONGS
        with np.errstate(over="ignore"):
            at = (_mix(samples.astype(np.uint64) + self.seed[None, :]) % np.uint64(bits)).astype(np.int64)
        flat = (np.arange(len(samples))[:, None] * bits + at).ravel()
        odd = (np.bincount(flat, minlength=len(samples) * bits) & 1).astype(np.uint8)
        return np.packbits(odd.reshape(len(samples), bits), axis=1, bitorder="little").view(np.int64)


def text_key(text: Column) -> list[Column]:
    """Two 64-bit hashes that name a text."""
    t = F.coalesce(text, F.lit(""))
    return [F.xxhash64(t).alias("t1"), F.xxhash64(F.lit("second"), t).alias("t2")]


def sign(df: DataFrame, id_col: str, text_col: str, words: int, bands: int, rows: int, passed: tuple[str, ...] = ()) -> DataFrame:
    """One row for each row of ``df``: the passed columns, id, t1, t2 (name of
    the text), n_shingles, set_key (NULL without a set), keys (of the bands), s0.. (sketch)."""
    python_workers(df.sparkSession)
    given = df.select(*passed, F.col(id_col).alias("id"), *text_key(F.col(text_col)), F.col(text_col).alias("__text"))
    longs = [f"s{i}" for i in range(SKETCH_LONGS)]
    schema = T.StructType([*given.schema.fields[:-1], T.StructField("n_shingles", T.LongType()),
                           T.StructField("set_key", T.BinaryType()), T.StructField("keys", T.ArrayType(T.LongType())),
                           *(T.StructField(n, T.LongType()) for n in longs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer, hashes = Signer(bands, rows), WordHashes()
        for batch in batches:
            n, names = [], []
            samples = np.zeros((batch.num_rows, bands * rows), np.uint32)
            for k, text in enumerate(batch.column("__text").to_pylist()):
                found = shingle_set(text, words, hashes)
                n.append(len(found))
                names.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                if len(found):
                    samples[k] = signer.samples(found)
            keys = signer.band_keys(samples)
            sketch = signer.sketches(samples)
            out = pa.Table.from_batches([batch]).drop_columns(["__text"])
            for name, col in (("n_shingles", pa.array(n, pa.int64())), ("set_key", pa.array(names, pa.binary())),
                              ("keys", pa.ListArray.from_arrays(np.arange(len(n) + 1, dtype=np.int32) * bands, keys.ravel())),
                              *((c, pa.array(np.ascontiguousarray(sketch[:, i]))) for i, c in enumerate(longs))):
                out = out.append_column(name, col)
            yield from out.to_batches()

    return given.mapInArrow(run, schema)


def full_sets(texts: DataFrame, words: int) -> DataFrame:
    """(set_key, shingles) from (set_key, __text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(t, words, hashes).view(np.int64) for t in batch.column("__text").to_pylist()]
            ends = np.concatenate(([0], np.cumsum([len(x) for x in sets]))).astype(np.int32)
            values = np.concatenate(sets) if sets else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("set_key"), pa.ListArray.from_arrays(ends, values)],
                                             names=["set_key", "shingles"])

    return texts.mapInArrow(run, "set_key binary, shingles array<long>")


def _enough(threshold: int, a: str, b: str) -> Column:
    """The most that the two sets can have in common reaches the threshold."""
    most = F.least(F.col(f"{a}.most"), F.col(f"{b}.most"))
    return 100 * most >= threshold * (F.col(f"{a}.n_shingles") + F.col(f"{b}.n_shingles") - most)


# -- candidates and links ----------------------------------------------------------

def _near(threshold: int, samples: int, a: str, b: str) -> Column:
    """The pair's sizes and sketches allow a link."""
    differ = sum((F.bit_count(F.col(f"{a}.s{i}").bitwiseXOR(F.col(f"{b}.s{i}"))) for i in range(1, SKETCH_LONGS)),
                 F.bit_count(F.col(f"{a}.s0").bitwiseXOR(F.col(f"{b}.s0"))))
    na, nb = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    return ((100 * F.least(na, nb) >= threshold * F.greatest(na, nb))
            & (differ <= most_bits(threshold, samples)))


def sets_of(keys: DataFrame, classes: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """(set_key, shingles) of the classes in ``keys`` (staged), staged.  ``docs`` has t1,
    t2 and __text; ``classes`` has set_key, t1, t2 (one text of each)."""
    texts = stage(classes.select("set_key", "t1", "t2").join(if_small(keys), "set_key"), "wanted")
    found = docs.join(if_small(texts), ["t1", "t2"])
    one = found.groupBy("set_key").agg(F.first("__text").alias("__text"))  # equal texts: any one
    return stage(full_sets(one, words), "sets")


def _linked(threshold: int, x: str, y: str) -> Column:
    """The two full sets reach the threshold."""
    common = F.size(F.array_intersect(x, y)).cast("long")
    return (100 + threshold) * common >= threshold * (F.size(x) + F.size(y))


def confirm(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The (staged) pairs (a, b) of set keys whose full sets reach the threshold."""
    left = sets.withColumnsRenamed({"set_key": "a", "shingles": "x"}).join(if_small(pairs), "a")
    both = left.join(sets.withColumnsRenamed({"set_key": "b", "shingles": "y"}), "b")
    return both.where(_linked(threshold, "x", "y")).select("a", "b")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("set_key")).union(pairs.select("b")).distinct()


def _open(members: DataFrame, found: DataFrame, centre: str) -> DataFrame:
    """Members, with their component, of buckets that hold several components
    besides the centre."""
    labelled = (members.drop("component").join(if_small(found.withColumnRenamed("node", "set_key")), "set_key", "left")
                .withColumn("component", F.coalesce("component", "set_key")).where(F.col("set_key") != F.col(centre)))
    buckets = (labelled.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
               .where("lo <> hi").select("bucket"))
    return labelled.join(if_small(stage(buckets, "open-buckets")), "bucket")


def classes_of(signed: DataFrame) -> DataFrame:
    """One row for each set (staged): its signature, one of its texts, the least
    id and the number of its rows."""
    longs = [f"s{i}" for i in range(SKETCH_LONGS)]
    return stage(signed.where("set_key IS NOT NULL").groupBy("set_key").agg(
        F.min(F.struct("t1", "t2")).alias("t"), F.first("n_shingles").alias("n_shingles"),
        F.first("keys").alias("keys"), *(F.first(c).alias(c) for c in longs),
        F.min("id").alias("least_id"), F.count("*").alias("n_rows"))
        .select("set_key", "t.t1", "t.t2", "n_shingles", "keys", *longs, "least_id", "n_rows"), "classes")


def link(classes: DataFrame, docs: DataFrame, words: int, threshold: int, bands: int, rows: int) -> DataFrame:
    """(set_key, component) of all classes that are linked with another;
    component is the smallest set key."""
    longs = [f"s{i}" for i in range(SKETCH_LONGS)]
    placed = classes.select("set_key", F.explode("keys").alias("bucket"))
    shared = stage(placed.groupBy("bucket").agg(F.min("set_key").alias("least"), F.count("*").alias("n"))
                   .where("n > 1").select("bucket", "least"), "buckets")
    members = stage(placed.join(if_small(shared), "bucket"), "members")
    facts = classes.select("set_key", "n_shingles", *longs)
    samples = bands * rows

    # 1. every member with the smallest class of its bucket
    stars = members.where("set_key <> least").select(F.col("least").alias("a"), F.col("set_key").alias("b")).distinct()
    n = classes.count()
    likely = stage(stars.join(if_small(facts, n).alias("p"), F.col("a") == F.col("p.set_key"))
                   .join(if_small(facts, n).alias("q"), F.col("b") == F.col("q.set_key"))
                   .where(_near(threshold, samples, "p", "q")).select("a", "b"), "stars")
    sets = sets_of(stage(_ends(likely), "ends"), classes, docs, words)
    links = stage(confirm(likely, sets, threshold), "links")
    found = stage(labels(links, "a", "b"), "labels")

    # 2. in buckets that still hold several components: every member with the class that has the fewest shingles of
    # its own.  Shingles that no other of these classes has can be in no common part, so n - own bounds it.
    rest = stage(_open(members, found, "least").select("bucket", "set_key", "component"), "open")
    if rest.isEmpty():
        return components(links, "a", "b").withColumnRenamed("node", "set_key")
    keys = stage(rest.select("set_key").distinct(), "open-keys")
    missing = keys.join(if_small(sets.select("set_key")), "set_key", "left_anti")
    sets = sets.join(if_small(keys), "set_key", "left_semi").unionByName(
        sets_of(stage(missing, "missing"), classes, docs, words))
    sets = stage(sets, "open-sets")
    alone = (sets.select("set_key", F.explode("shingles").alias("shingle")).groupBy("shingle")
             .agg(F.count("*").alias("n"), F.min("set_key").alias("set_key")).where("n = 1")
             .groupBy("set_key").agg(F.count("*").alias("own")))
    facts = classes.select("set_key", "n_shingles", *longs, "keys").join(if_small(keys), "set_key")
    facts = stage(facts.join(alone, "set_key", "left").fillna(0, ["own"])
                  .withColumn("most", F.col("n_shingles") - F.col("own"))
                  .where(100 * F.col("most") >= threshold * F.col("n_shingles")), "open-facts")
    rest = stage(rest.join(if_small(facts), "set_key"), "candidates")
    centres = rest.groupBy("bucket").agg(F.min(F.struct("own", "set_key")).alias("c")).select("bucket", F.col("c.set_key").alias("centre"))
    rest = stage(rest.join(if_small(stage(centres, "centres")), "bucket"), "centred")
    stars = (rest.where("set_key <> centre").select(F.col("centre").alias("a"), F.col("set_key").alias("b"), "component").distinct()
             .join(if_small(facts).alias("p"), F.col("a") == F.col("p.set_key"))
             .join(if_small(facts).alias("q"), F.col("b") == F.col("q.set_key"))
             .where(_near(threshold, samples, "p", "q") & _enough(threshold, "p", "q")).select("a", "b"))
    links = stage(links.unionByName(confirm(stage(stars, "stars"), sets, threshold)), "links")
    found = stage(labels(links, "a", "b"), "labels")

    # 3. what is left: pairs of different components that sizes, sketches and bounds let through are compared on
    # their full sets inside the join, which emits links only; a pair is compared in its first common bucket (in a
    # bucket that is missing here it has one component, or one of the pair was tried with all members)
    rest = stage(sets.join(_open(rest, found, "centre"), "set_key"), "open")
    p, q = rest.alias("p"), rest.alias("q")
    more = stage(p.join(q, (F.col("p.bucket") == F.col("q.bucket")) & (F.col("p.set_key") < F.col("q.set_key"))
                        & (F.col("p.component") != F.col("q.component")) & _near(threshold, samples, "p", "q")
                        & _enough(threshold, "p", "q")
                        & (F.array_min(F.array_intersect("p.keys", "q.keys")) == F.col("p.bucket"))
                        & _linked(threshold, "p.shingles", "q.shingles"))
                 .select(F.col("p.set_key").alias("a"), F.col("q.set_key").alias("b")), "links")
    return components(links.unionByName(more), "a", "b").withColumnRenamed("node", "set_key")


def group(signed: DataFrame, docs: DataFrame, words: int, threshold: int) -> DataFrame:
    """(set_key, component, component_id) of the classes of several rows or with
    links, staged; component_id is the least id of the component."""
    classes = classes_of(signed)
    linked = stage(link(classes, docs, words, threshold, *bands_for(threshold)), "linked")
    ids = classes.select("set_key", "least_id", "n_rows").join(if_small(linked), "set_key", "left")
    ids = stage(ids.where("component IS NOT NULL OR n_rows > 1"), "grouped")
    least = ids.where("component IS NOT NULL").groupBy("component").agg(F.min("least_id").alias("component_id"))
    alone = ids.where("component IS NULL").select("set_key", F.col("set_key").alias("component"), F.col("least_id").alias("component_id"))
    return stage(ids.select("set_key", "component").join(least, "component")
                 .select("set_key", "component", "component_id").unionByName(alone), "groups")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                    threshold: int = 80) -> DataFrame:
    """One row for each row of ``df``: id, n_shingles, component_id, kept (id =
    component_id) and set_key and component (hashes of sets; NULL without one).

    Two sets are linked when 100 * common >= threshold * union.
    """
    signed = stage(sign(df, id_col, text_col, words, *bands_for(threshold)), "signed")
    docs = df.select(*text_key(F.col(text_col)), F.col(text_col).alias("__text"))
    known = group(signed, docs, words, threshold)
    out = signed.select("id", "n_shingles", "set_key").join(if_small(known), "set_key", "left")
    component_id = F.coalesce("component_id", "id")  # a class of one row without links is its own component
    return out.select(F.col("id").alias(id_col), "n_shingles", component_id.alias("component_id"),
                      F.col("id").eqNullSafe(component_id).alias("kept"), "set_key",
                      F.coalesce("component", "set_key").alias("component"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, threshold: int = 80) -> DataFrame:
    """One row of each group of near duplicates with all columns of ``df``: the
    one with the least id (NULL ids last), of equal ids the first in the input.
    Rows without a set all stay."""
    rows = df.select(F.struct(*df.columns).alias("__doc"), F.col(id_col).alias("__id"), F.col(text_col).alias("__words"),
                     F.monotonically_increasing_id().alias("__row"))
    signed = stage(sign(rows, "__id", "__words", words, *bands_for(threshold), passed=("__doc", "__row")), "signed")
    docs = signed.select("t1", "t2", F.col("__doc")[text_col].alias("__text"))
    known = group(signed, docs, words, threshold).select("set_key", "component")
    place = F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("__row"))
    found = stage(signed.select("id", "__row", "set_key").join(if_small(known), "set_key"), "group-rows")
    best = found.groupBy("component").agg(F.min(place).alias("p")).select(F.col("p.__row").alias("__row"))
    gone = stage(found.select("__row").join(best, "__row", "left_anti"), "gone")
    return signed.select("__row", "__doc").join(if_small(gone), "__row", "left_anti").select("__doc.*")


#: DuckDB SQL of the contract's result (3 words, 85) over documents with distinct ids.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 2], ' ') AS shingle
  FROM (SELECT *, unnest(range(1, greatest(2, len(words) - 1))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.size + y.size - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other)
SELECT r.doc_id, coalesce(any_value(n.size), 0)::BIGINT AS n_shingles, min(other) AS component_id,
       r.doc_id = min(other) AS kept
FROM reach r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""
