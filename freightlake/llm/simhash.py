"""SimHash near-duplicates by covering locality-sensitive hashing.

A text's fingerprint has a bit set if more than half of its word shingles (four
words, A-Z lower-cased, repeats included) have it set in their XXH64.  Equal
fingerprints are one class.  Fingerprints link at ``radius`` or fewer differing bits.

Candidates come from structured bit masks: each of the 64 bit positions gets one of
the 2^(r+1) - 1 non-zero vectors of r+1 bits, all of them about equally often, and
the mask of a non-zero vector v holds the positions whose vector has an odd inner
product with v.  Any r positions have a v that is orthogonal to all their vectors,
so two fingerprints that differ in at most r bits agree under v's mask: every pair
within the radius collides in some table (31 tables of 32 or so bits for radius 4).
Candidates are confirmed by the population count of their XOR.

Links are wanted for their connected components.  A bucket of up to ``HOT`` different
fingerprints is joined with itself.  For fingerprints of larger buckets every bit
pattern within half the radius is written: two fingerprints are within the radius
exactly if they share such a midpoint, and at most 2,081 (radius 4) can share one, so
linking each to the midpoint's least finds all their links without pairs of a bucket.

Defined results: NULL, empty and wordless texts have fingerprint zero, linked like
any other; a text with fewer words than a shingle is one shingle.  The component of
a document is the smallest id of its component (NULL ids do not count; a component of
NULL ids only has a NULL id).  Repeated rows and equal ids are rows of their own.
Very long texts are hashed in slices.  An empty table gives an empty result; other
columns are not read, whatever their names.

At scale: fingerprints are written once (an id and a long each); copies are one class
before any table, counted map-side; the tables hold 31 rows of two longs for a class.
Tables of a row or more for each class are joined by merging: Spark sizes exploded rows
as what they come from, packed files by their bytes, and would send them to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlake.llm.common import python_workers, stage
from freightlake.llm.components import components

SEED = 42
SLICE = 1 << 15
HOT = 256


def fingerprint(text: bytes | None, words: int = 4) -> int:
    """Fingerprint of a UTF-8 text, unsigned."""
    found = (text or b"").lower().split()  # ASCII letters and ASCII white space only
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words, len(found))
    starts, ends = starts[:len(starts) - k + 1], ends[k - 1:]
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), SLICE):
        pairs = zip(starts[at:at + SLICE].tolist(), ends[at:at + SLICE].tolist(), strict=True)
        h = np.array([digest(joined[a:b], SEED) for a, b in pairs], dtype="<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << b for b in np.flatnonzero(2 * votes > len(starts)).tolist())


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def masks(radius: int, bits: int = 64) -> list[int]:
    """One mask for each non-zero vector of radius + 1 bits."""
    count = (1 << radius + 1) - 1
    vectors = [i % count + 1 for i in range(bits)]
    return [sum(1 << i for i, a in enumerate(vectors) if (a & v).bit_count() % 2) for v in range(1, count + 1)]


def ball(radius: int, bits: int = 64) -> list[int]:
    """All patterns of up to ``radius`` set bits."""
    return [sum(1 << b for b in c) for n in range(radius + 1) for c in combinations(range(bits), n)]


def _longs(values: list[int]) -> Column:
    return F.array(*(F.lit(signed(v)).cast("long") for v in values))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """(id, fp) of every row; fp is a signed long."""
    python_workers(docs.sparkSession)
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").cast(pa.binary())
            found = [signed(fingerprint(t.as_py(), words)) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(found, pa.int64())], names=["id", "fp"])

    return given.mapInArrow(run, f"id {given.schema['id'].dataType.simpleString()}, fp long")


def links(classes: DataFrame, radius: int = 4, hot: int = HOT) -> DataFrame:
    """(a, b), a < b: links of the distinct fingerprints ``fp`` that connect all that
    are linked; every row is a link, not every link between members of one component
    in a hot bucket has a row."""
    if radius % 2:
        raise ValueError("radius must be even: midpoints lie half-way")
    tables = F.transform(_longs(masks(radius)), lambda m, i: F.xxhash64(i, F.col("fp").bitwiseAND(m)))
    keys = classes.select("fp", F.explode(tables).alias("key"))
    buckets = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    members = stage(keys.join(buckets.hint("merge"), "key"), "buckets")
    cool = members.where(F.col("n") <= hot)
    a, b = cool.select("key", F.col("fp").alias("a")), cool.select("key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    pairs = a.join(b.hint("merge"), "key").where(F.col("a") < F.col("b")).where(near).select("a", "b").distinct()
    crowded = members.where(F.col("n") > hot).select("fp").distinct()
    middle = F.explode(F.transform(_longs(ball(radius // 2)), lambda m: F.col("fp").bitwiseXOR(m))).alias("mid")
    shared = (crowded.select("fp", middle).groupBy("mid").agg(F.collect_list("fp").alias("fps"))  # at most a ball's size
              .where(F.size("fps") > 1).select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")))
    return pairs.unionByName(shared.where("a < b").distinct()).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
                    radius: int = 4, hot: int = HOT) -> DataFrame:
    """id, fingerprint (16 hex digits), component_id for each row."""
    rows = stage(fingerprints(docs, id_col, text_col, words), "fingerprints")
    classes = stage(rows.groupBy("fp").agg(F.min("id").alias("least")), "fingerprint-classes")
    edges = stage(links(classes, radius, hot), "fingerprint-links")
    of = components(edges, "a", "b").hint("merge")
    linked = classes.join(of, F.col("fp") == F.col("node")).select("fp", "component", "least")
    named = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = linked.join(named, "component").select(F.col("fp").alias("node"), "component_id")
    found = (classes.join(labels, F.col("fp") == F.col("node"), "left")
             .select("fp", F.when(F.col("node").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id")))
    found = stage(found, "fingerprint-components")  # a plain join, whose hot fingerprints are split
    return (rows.join(found.hint("merge"), "fp")
            .select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))
