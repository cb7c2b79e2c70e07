"""Line dedup by overlapping three-line windows.

Lines that hold more than white space are taken in order, blank ones between
them are passed over.  Every three consecutive lines (trimmed) form a window; a
128-bit hash names it.  Windows found more than once anywhere are repeated: the
first place stays (smallest id, then place in the input, then line), and every
later place covers its three lines.  Covered lines are removed; overlapping
covers merge because they are sets of line numbers.  Each removed line still
stands at the first place of its window, or where that was covered in turn, at
an earlier one.

Defined results: NULL or empty text, and texts of fewer than three lines, come
back as they are; rows with the same id, repeated rows and rows with NULL ids
are told apart by their place in the input (NULL ids come last); an empty table
gives an empty result; all other columns pass through, also ones with names
used inside.

At scale: the texts are staged once with a row number; windows are 40 bytes and
are shuffled for one map-side-combined count and one join on the window's hash
(a window in a third of all documents is one row on the counted side, and its
occurrences are split by the adaptive skew join).  Only covered line numbers of
one document meet in one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlake.llm.common import fresh, let, stage

WINDOW = 3
BLANK = r"^[\x20\x09-\x0D]*$"


def number_rows(df: DataFrame, name: str) -> DataFrame:
    """``df`` staged in the shared folder with a row number that stays the same
    for every later reader."""
    return stage(df.withColumn(name, F.monotonically_increasing_id()), "numbered")


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_windows(docs: DataFrame, row: str, id_col: str, text_col: str) -> DataFrame:
    """A row (row, id, first, lines, h1, h2) for each window of each document;
    ``lines`` are the numbers of its three lines in the text."""
    full = F.filter(F.transform(_lines(F.col(text_col)), lambda x, i: F.struct(F.trim(x, F.lit(" \t\x0b\x0c\r")).alias("x"), i.alias("i"))),
                    lambda s: s["x"] != "")

    def windows(s: Column) -> Column:
        at = lambda i, k: F.get(s, i + k)
        return F.when(F.size(s) >= WINDOW, F.transform(
            F.sequence(F.lit(0), F.size(s) - WINDOW),
            lambda i: F.struct(
                i.alias("first"),
                F.array(*[at(i, k)["i"] for k in range(WINDOW)]).alias("lines"),
                F.xxhash64(*[at(i, k)["x"] for k in range(WINDOW)]).alias("h1"),
                F.xxhash64(F.lit("second"), *[at(i, k)["x"] for k in reversed(range(WINDOW))]).alias("h2"))))

    return (docs.select(F.col(row).alias("row"), F.col(id_col).alias("id"),
                        F.explode(let(full, windows)).alias("w"))
            .select("row", "id", "w.*"))


def covered_lines(windows: DataFrame) -> DataFrame:
    """(row, covered): for each document the numbers of the lines that later
    occurrences of repeated windows cover."""
    place = F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("row"), F.col("first"))
    repeated = (windows.groupBy("h1", "h2").agg(F.min(place).alias("keep"), F.count("*").alias("n"))
                .where("n > 1").select("h1", "h2", "keep.row", "keep.first")
                .withColumnsRenamed({"row": "keep_row", "first": "keep_first"}))
    later = (windows.join(repeated, ["h1", "h2"])
             .where((F.col("row") != F.col("keep_row")) | (F.col("first") != F.col("keep_first"))))
    return (later.groupBy("row").agg(F.collect_set("lines").alias("sets"))
            .select("row", F.array_distinct(F.flatten("sets")).alias("covered")))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                counts: bool = False) -> DataFrame:
    """``df`` with covered lines removed from the text; with ``counts`` also
    n_lines (lines of the text) and n_removed."""
    row, hit = fresh(df, "__row"), fresh(df, "__covered")
    docs = number_rows(df, row)
    windows = stage(line_windows(docs, row, id_col, text_col), "windows")
    covered = covered_lines(windows).withColumnsRenamed({"row": row, "covered": hit})
    joined = docs.join(covered, row, "left")

    def without(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(hit))
        return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")

    text = F.when(F.col(hit).isNull(), F.col(text_col)).otherwise(let(_lines(F.col(text_col)), without))
    out = [text.alias(c) if c == text_col else F.col(c) for c in df.columns]
    if counts:
        out += [F.size(_lines(F.col(text_col))).cast("long").alias("n_lines"),
                F.coalesce(F.size(hit), F.lit(0)).cast("long").alias("n_removed")]
    return joined.select(*out)


ORACLE = r"""
WITH l AS (
  SELECT doc_id, i - 1 AS line, trim(lines[i], ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS x
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents))),
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS k FROM l WHERE x <> ''),
w AS (
  SELECT a.doc_id, a.k, [a.line, b.line, c.line] AS lines, a.x AS x, b.x AS y, c.x AS z
  FROM n a JOIN n b ON b.doc_id = a.doc_id AND b.k = a.k + 1
           JOIN n c ON c.doc_id = a.doc_id AND c.k = a.k + 2),
o AS (SELECT *, row_number() OVER (PARTITION BY x, y, z ORDER BY doc_id, k) AS r FROM w),
c AS (SELECT DISTINCT doc_id, unnest(lines) AS line FROM o WHERE r > 1),
k AS (
  SELECT d.doc_id, d.line, c.line IS NOT NULL AS gone, t.lines[d.line + 1] AS raw
  FROM l d LEFT JOIN c ON c.doc_id = d.doc_id AND c.line = d.line
  JOIN (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents) t ON t.doc_id = d.doc_id)
SELECT doc_id, coalesce(string_agg(raw, chr(10) ORDER BY line) FILTER (WHERE NOT gone), '') AS text,
       count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_removed
FROM k GROUP BY doc_id
"""
