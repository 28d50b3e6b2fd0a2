"""Sharding along a Hilbert curve: rows that are near in several metadata dimensions share a shard and a file range.

Every dimension is quantised at approximate quantiles, the quantised point is turned into its index on the curve, rows
are ordered by (index, id), and the order is cut into runs whose row counts differ by one at most. All of it is column
expressions; no row passes through Python.

The global order needs no single sorted partition: the curve has a bounded number of cells, cells are counted, a cell
with many rows is split by a hash of its ids, and a row's place is the rows before its part plus its number inside it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldhouse.llm.common import saved, text_bytes

PART_ROWS = 20_000
"""Rows of a curve cell that one window group may hold; fuller cells are split by hash."""


def text_rank(text: str | Column) -> Column:
    """A number that sorts as the first seven bytes of a string do."""
    head = F.substring(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 1, 7)
    return F.conv(F.rpad(F.hex(head), 14, "0"), 16, 10).cast("long")


def quantised(df: DataFrame, dims: Mapping[str, Column], bits: int) -> tuple[DataFrame, dict[str, list[float]]]:
    """`df` with one column per dimension holding 0 .. 2**bits - 1: the number of quantile cuts below the value.

    Nulls go to 0. The cuts are one row of 2**bits - 1 numbers per dimension, whatever the input's size.
    """
    cells = 1 << bits
    shares = [i / cells for i in range(1, cells)]
    df = df.withColumns({f"_d_{k}": c.cast("double") for k, c in dims.items()})
    row = df.agg(*[F.percentile_approx(f"_d_{k}", shares, 1000).alias(k) for k in dims]).first()
    cuts = {k: [float(x) for x in (row[k] or [])] for k in dims}

    def level(k: str) -> Column:
        below = [(F.col(f"_d_{k}") > F.lit(c)).cast("int") for c in cuts[k]]
        return F.coalesce(sum(below, F.lit(0)), F.lit(0)).cast("long")

    return df.withColumns({k: level(k) for k in dims}).drop(*[f"_d_{k}" for k in dims]), cuts


def hilbert_index(levels: list[Column], bits: int) -> Column:
    """Index on the Hilbert curve of a point with the given coordinates of `bits` bits each.

    Inverse undo of the curve's rotations, from the top bit down, then a Gray code, then the bits interleaved.
    """
    n = len(levels)
    at = lambda a, i: F.element_at(a, (i + 1).cast("int"))
    steps = F.array(*[F.struct(F.lit(1 << b).cast("long").alias("q"), F.lit(i).alias("i"))
                      for b in range(bits - 1, 0, -1) for i in range(n)])

    def turn(x: Column, s: Column) -> Column:
        low = s["q"] - 1
        own, first = at(x, s["i"]), at(x, F.lit(0))
        swap = first.bitwiseXOR(own).bitwiseAND(low)
        flip = own.bitwiseAND(s["q"]) != 0
        return F.transform(x, lambda v, j: F.when(flip, F.when(j == 0, v.bitwiseXOR(low)).otherwise(v)).otherwise(
            F.when((j == 0) | (j == s["i"]), v.bitwiseXOR(swap)).otherwise(v)))

    x = F.array(*[c.cast("long") for c in levels])
    x = F.aggregate(steps, x, turn) if bits > 1 else x
    # Gray code: coordinate i takes the exclusive or of all coordinates up to i
    x = F.transform(x, lambda v, j: F.aggregate(F.slice(x, 1, j + 1), F.lit(0).cast("long"), lambda a, b: a.bitwiseXOR(b)))
    masks = F.array(*[F.lit(1 << b).cast("long") for b in range(bits - 1, 0, -1)]) if bits > 1 else None

    def done(y: Column) -> Column:
        last = at(y, F.lit(n - 1))
        t = F.lit(0).cast("long") if masks is None else F.aggregate(
            masks, F.lit(0).cast("long"),
            lambda a, q: F.when(last.bitwiseAND(q) != 0, a.bitwiseXOR(q - 1)).otherwise(a))
        places = F.array(*[F.struct(F.lit(1 << b).cast("long").alias("q"), F.lit(i).alias("i"))
                           for b in range(bits - 1, -1, -1) for i in range(n)])
        bit = lambda s: F.when(at(y, s["i"]).bitwiseXOR(t).bitwiseAND(s["q"]) != 0, 1).otherwise(0)
        return F.aggregate(places, F.lit(0).cast("long"), lambda a, s: a * 2 + bit(s))

    return F.element_at(F.transform(F.array(x), done), 1)


def with_place(df: DataFrame, cell: str, ids: list[str], part_rows: int = PART_ROWS) -> tuple[DataFrame, int]:
    """`df` with `place`, its 0-based number in the order of (cell, part of the cell, ids), and the number of rows.

    `df` is read three times, so it should be a written table. A cell with over `part_rows` rows is split into parts
    by a hash of the ids. Rows that agree in all ids get neighbouring places in any order.
    """
    cells = df.groupBy(cell).agg(F.count("*").alias("_rows"))
    split = cells.select(cell, F.ceil(F.col("_rows") / part_rows).alias("_parts"))  # bounded: one row per curve cell
    rows = df.join(F.broadcast(split), cell).withColumn("_part", F.pmod(F.xxhash64(*ids), "_parts"))
    before = Window.orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)  # over the bounded table of cells
    cells = cells.select(cell, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_cells_before"))
    within = Window.partitionBy(cell).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy(cell, "_part").agg(F.count("*").alias("_n")).select(
        cell, "_part", F.coalesce(F.sum("_n").over(within), F.lit(0)).alias("_parts_before"))
    starts = parts.join(F.broadcast(cells), cell).select(
        F.col(cell).alias("_c"), F.col("_part").alias("_p"), (F.col("_cells_before") + F.col("_parts_before")).alias("_start"))
    number = F.row_number().over(Window.partitionBy(cell, "_part").orderBy(*ids))
    numbered = rows.withColumn("_rn", number)
    out = numbered.join(starts, (F.col(cell) == F.col("_c")) & (F.col("_part") == F.col("_p")))
    total = df.count()
    return out.withColumn("place", F.col("_start") + F.col("_rn") - 1).drop("_c", "_p", "_start", "_rn", "_part", "_parts"), total


def hilbert_shards(docs: DataFrame, shards: int = 8, bits: int = 3) -> DataFrame:
    """One row per row of `docs`: doc_id, size, text_crc32, curve, place, shard, slot, and the file-pruning levels.

    Dimensions: language, source, text size and id, 2**bits levels each. Law `rows`: shard counts are at most one apart.
    Null text has size 1 and a null crc32 of the empty string's (0); null metadata goes to level 0; repeated rows take
    neighbouring slots; an empty table gives an empty result. Columns besides doc_id, text, lang and source are unread.
    """
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (text_bytes("text") + 1).alias("size"),
        F.crc32(F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))).cast("long").alias("text_crc32"),
        text_rank("lang").alias("_lang"), text_rank("source").alias("_source"))
    slim = saved(slim, "hilbert-slim")
    dims = {"lang_level": F.col("_lang"), "source_level": F.col("_source"), "size_level": F.col("size"), "id_level": F.col("doc_id")}
    points, _ = quantised(slim, dims, bits)
    curve = saved(points.withColumn("curve", hilbert_index([F.col(k) for k in dims], bits)).drop("_lang", "_source"), "hilbert-curve")
    placed, total = with_place(curve, "curve", ["doc_id", "size", "text_crc32"])
    shard = F.expr(f"place * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")  # the first place of a shard
    return placed.withColumn("shard", shard.cast("int")).withColumn("slot", F.col("place") - first)
