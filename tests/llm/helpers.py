"""Small tables with awkward rows, and brute-force versions of the operators."""

from __future__ import annotations

import re

from pyspark.sql import types as T

DOC_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

PROSE = ("the old harbour lay quiet while seven boats came home from the northern banks with nets full of herring and "
         "the women on the quay counted baskets until the lamps were lit and the priest walked down to bless the catch "
         "as he had done every autumn since the great storm took the lighthouse and half of the village with it")


def prose(n: int, salt: int = 0) -> str:
    """``n`` different words."""
    return " ".join(f"w{salt}x{i}y{(i * 7919 + salt) % 1013}" for i in range(n))


def awkward(spark):
    """NULLs in every column, empty and very long texts, ties and repeated rows."""
    rows = [
        (1, PROSE, "en", "a", 1), (2, PROSE, "en", "a", 1), (2, PROSE, "en", "a", 1), (3, "", "en", None, 0),
        (4, None, None, "b", None), (None, PROSE + " once more", "en", "b", 5), (None, None, None, None, None),
        (None, None, None, None, None), (5, " \n\t \n", "fr", "c", 4), (6, prose(60_000), "de", "c", 9),
        (7, "one two", "es", "c", 7), (8, "x" * 200_000, "en", "c", 9), (9, "ünï ☃ 日本語 " * 40, "ja", "c", 9),
        (10, "a\nb\nc\na\nb\nc\na\nb\nc", "en", "c", 9)]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def empty(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def clashing(df, *names):
    """``df`` with extra columns of these names."""
    for name in names:
        df = df.withColumn(name, df["source"])
    return df


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingle_sets(rows, k):
    out = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        out.append(frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset())
    return out


def brute_components(rows, k, threshold):
    """Component number of each (id, text): rows are joined when their sets are
    linked; rows without a set stay alone."""
    sets = shingle_sets(rows, k)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * min(len(a), len(b)) >= threshold * max(len(a), len(b)):
                common = len(a & b)
                if 100 * common >= threshold * (len(a) + len(b) - common):
                    root[find(i)] = find(j)
    return [find(i) for i in range(len(rows))], sets


def brute_lines(rows):
    """(kept text, removed lines) of each (id, text) in input order, ids NULL last."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seen, out = set(), [None] * len(rows)
    for i in order:
        lines = (rows[i][1] or "").split("\n")
        full = [(n, x.strip(" \t\x0b\x0c\r")) for n, x in enumerate(lines)]
        full = [x for x in full if x[1]]
        gone = set()
        for k in range(len(full) - 2):
            window = tuple(x for _, x in full[k:k + 3])
            if window in seen:
                gone |= {n for n, _ in full[k:k + 3]}
            seen.add(window)
        out[i] = ("\n".join(x for n, x in enumerate(lines) if n not in gone) if gone else rows[i][1], len(gone))
    return out
