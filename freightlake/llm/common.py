"""Small helpers shared by the text operators."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlake.session import scratch_path

#: Between words: space, tab, line feed, vertical tab, form feed, carriage return.
GAP = r"[\x20\x09-\x0D]+"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def python_workers(spark: SparkSession, rows: int = 256) -> None:
    """Settings for operators that run Python in tasks: Arrow batches of few
    rows (a row is a whole document, which may be long), and on one machine the
    path of this package (a cluster gets it with the job)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    sc = spark.sparkContext
    if sc.master.startswith("local"):
        paths = sc.environment.get("PYTHONPATH", "").split(os.pathsep)
        if ROOT not in paths:
            sc.environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, paths)])


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: cuts the lineage,
    and every later reader sees the same rows also after executors were lost."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: A side of a join is broadcast when it has at most so many (short) rows.
BROADCAST_ROWS = 500_000


def if_small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` marked for broadcast if it has few rows, else as it is.  ``rows``
    is a known bound; without it a staged table's rows are counted."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value`` evaluated once: inside a lambda an ordinary
    expression would be evaluated again for each element."""
    return F.transform(F.array(value), body)[0]


def word_list(text: Column, gap: str = GAP) -> Column:
    """Words between gaps; NULL text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), gap), lambda w: w != "")


def ascii_lower(text: Column) -> Column:
    """Lower case for A-Z as far as ASCII words go: ``lower`` also maps the
    Kelvin sign to ``k``, so texts with it take the slower exact way."""
    t = F.coalesce(text, F.lit(""))
    return F.when(F.contains(t, F.lit("K")),
                  F.translate(t, ASCII_UPPER, ASCII_UPPER.lower())).otherwise(F.lower(t))


def id_text(id_col: str) -> Column:
    """The id as text bytes, as label folds hash it."""
    return F.col(id_col).cast("string").cast("binary")
