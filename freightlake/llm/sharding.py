"""Consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into a fixed number of cells.  Each shard has ``vnodes`` virtual
nodes at hashed cells; a key belongs to the cell of its hash and prefers the
first virtual node at or after that cell.  Loads are bounded: shard s takes at
most ``floor(n / shards)`` rows, one more for the first ``n mod shards`` shards,
and what overflows a full shard goes on clockwise to the next virtual node of a
shard with room.  So row counts differ by at most one (the ``rows`` law), and a
shard more or less moves only its share and what overflows differently.

The ring's cells are counted by Spark; the driver sees one number for each cell
(at most ``CELLS``, whatever the input) and plans pieces "ranks a to b of this
cell go to shard s, from slot t".  Rows are ranked inside their cell by the
hash of their content, in sub-cells whose number grows with the input, so that
no task holds an unbounded cell even if one key has a third of all rows.

Defined results: NULL keys share one ring cell; rows with equal keys or equal
content are rows of their own and get slots of their own; NULL text has size 8
and the checksum of the empty text; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from freightlake.llm.common import fresh, stage

CELLS = 1 << 14
VNODES = 64


def cell_of(key: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit("key"), key), 50).cast("int")  # 64 - log2(CELLS)


def ring(spark: SparkSession, shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, in ring order; a virtual node's cell
    depends on its shard and number alone."""
    nodes = spark.range(shards * vnodes).select(
        (F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).cast("int").alias("vnode"))
    nodes = nodes.select("shard", F.xxhash64(F.lit("vnode"), "shard", "vnode").alias("h"))
    return [(r[0], r[1]) for r in nodes.select(F.shiftrightunsigned("h", 50).cast("int").alias("cell"), "shard", "h")
            .orderBy("cell", "h").collect()]


def plan_pieces(loads: dict[int, int], nodes: list[tuple[int, int]], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(cell, from, to, shard, slot): ranks from..to-1 of the cell go to the
    shard, the first of them to the slot.

    Round by round each cell offers what it has left to the next virtual node
    clockwise, first to the one it prefers; a shard takes offers in ring order
    until it is full.
    """
    taken, pieces = [0] * len(room), []
    starts, k = {}, 0
    for cell in sorted(loads):
        while k < len(nodes) and nodes[k][0] < cell:
            k += 1
        starts[cell] = k
    left = {c: 0 for c in sorted(loads) if loads[c]}  # rows placed so far
    for hop in range(len(nodes)):
        if not left:
            break
        for cell in list(left):
            shard = nodes[(starts[cell] + hop) % len(nodes)][1]
            n = min(loads[cell] - left[cell], room[shard] - taken[shard])
            if n > 0:
                pieces.append((cell, left[cell], left[cell] + n, shard, taken[shard]))
                taken[shard] += n
                left[cell] += n
            if left[cell] == loads[cell]:
                del left[cell]
    return pieces


def assign(df: DataFrame, key_col: str = "doc_id", text_col: str = "text", shards: int = 24,
           vnodes: int = VNODES, group_rows: int = 50_000, row_col: str | None = None) -> DataFrame:
    """One row for each row of ``df``: __row, key, size (UTF-8 bytes of the text
    plus 8), text_crc32, shard and slot.

    ``row_col`` names a column that numbers the rows of ``df`` already; without
    it the rows are numbered here.  ``group_rows`` bounds the rows of one sub-cell,
    on average even where all rows are in one cell.
    """
    spark = df.sparkSession
    utf8 = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    rows = stage(df.select(
        (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("__row"), F.col(key_col),
        (F.octet_length(utf8) + 8).cast("long").alias("size"), F.crc32(utf8).alias("text_crc32"),
        cell_of(F.col(key_col)).alias("__cell")), "ring-rows")
    loads = {r[0]: r[1] for r in rows.groupBy("__cell").count().collect()}  # at most CELLS rows
    n = sum(loads.values())
    room = [n // shards + (s < n % shards) for s in range(shards)]
    # each piece ends a cell or fills a shard: at most CELLS + shards rows
    pieces = spark.createDataFrame(plan_pieces(loads, ring(spark, shards, vnodes), room),
                                   "__cell int, __from long, __to long, shard int, __slot long")
    subs = 1
    while subs * group_rows < n:
        subs *= 2
    # the row number, folded, spreads rows of equal content
    order = F.xxhash64(key_col, "size", "text_crc32", F.pmod("__row", F.lit(subs)))
    rows = rows.withColumn("__order", order).withColumn("__sub", F.pmod("__order", F.lit(subs)).cast("int"))
    counts = rows.groupBy("__cell", "__sub").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("__cell").orderBy("__sub").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("__cell", "__sub", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy("__cell", "__sub").orderBy("__order", "__row")
    ranked = (rows.withColumn("__k", F.row_number().over(within) - 1).join(counts, ["__cell", "__sub"])
              .withColumn("__rank", F.col("__before") + F.col("__k")))
    return (ranked.join(F.broadcast(pieces), "__cell")
            .where("__rank >= __from AND __rank < __to")
            .select("__row", key_col, "size", "text_crc32", "shard",
                    (F.col("__slot") + F.col("__rank") - F.col("__from")).alias("slot")))


def write_shards(df: DataFrame, path: str, key_col: str = "doc_id", text_col: str = "text", shards: int = 24) -> DataFrame:
    """Write the rows of ``df`` as Parquet folders ``shard=s`` below ``path`` and
    return them as read back, with shard and slot."""
    own = fresh(df, "__number")
    numbered = stage(df.withColumn(own, F.monotonically_increasing_id()), "shard-input")
    placed = assign(numbered, key_col, text_col, shards, row_col=own)
    taken = [c for c in df.columns if c not in ("shard", "slot")]
    (numbered.select(own, *taken).join(placed.select(F.col("__row").alias(own), "shard", "slot"), own).drop(own)
     .write.partitionBy("shard").parquet(path))
    return df.sparkSession.read.parquet(path)
