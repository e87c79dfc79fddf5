"""Sharding by sampled splitters: key ranges of near-equal bytes, overfull ranges subdivided, ranges packed into shards."""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triagelake.core import cut
from triagelake.llm.common import text_of

#: Ranges per shard, and sampled keys per range.
RANGES, SAMPLES = 64, 64
#: Rows that one cell of a shard should hold when slots are numbered.
CELL_ROWS = 100_000
#: Bits of a key: whole numbers of this size are exact as doubles.
KEY_BITS = 52


@dataclass(frozen=True)
class Plan:
    """Splitters, the keys that fill a range alone, the pieces each range was cut into, and the shard of each piece.

    All lists are bounded by the number of shards times RANGES, not by the rows.
    """

    shards: int
    splitters: list[float]
    heavy: list[tuple[int, int]]  # key, range number
    cuts: list[tuple[int, int]]  # range number, pieces
    pieces: list[tuple[int, int, int]]  # range number, piece, shard
    cells: int


def record_key(text: str = "text") -> Column:
    """The place of a record in key order: a hash of its text, so equal texts are neighbours."""
    return F.shiftrightunsigned(F.xxhash64(text_of(text)), 64 - KEY_BITS)


def sized(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with _key, size (UTF-8 bytes of the text plus 1) and text_crc32; a null text is empty."""
    value = text_of(text)
    return docs.select("*", record_key(text).alias("_key"), (F.octet_length(value) + 1).cast("long").alias("size"),
                       F.crc32(value.cast("binary")).alias("text_crc32"))


def splitters(rows: DataFrame, total: int, ranges: int, key: str = "doc_id", seed: int = 13) -> list[float]:
    """Quantile boundaries of a size-weighted sample of keys: about SAMPLES keys for each range.

    A row is drawn with the chance size / unit (surely if larger) and stands for its own size or one unit,
    whichever is larger. The draw is a hash of seed, key and id. The sample has about ranges * SAMPLES rows at any size of input.
    """
    unit = max(1.0, total / (ranges * SAMPLES))
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "_key", key), 64 - KEY_BITS) / F.lit(float(1 << KEY_BITS))
    sample = rows.where(draw < F.col("size") / unit)
    times = F.greatest(F.lit(1), F.round(F.col("size") / unit)).cast("long")
    at = [i / ranges for i in range(1, ranges)]
    found = sample.agg(F.percentile(F.col("_key").cast("double"), F.array(*map(F.lit, at)), times)).first()[0] if at else []
    return sorted(set(found or []))


def _ranged(rows: DataFrame, bounds: Sequence[float], heavy: Sequence[tuple[int, int]]) -> DataFrame:
    """Adds ``_range``: the number of splitters up to the key, or the own range of a heavy key."""
    low, high = F.lit(0), F.lit(len(bounds))
    held = rows
    if bounds:
        held = held.withColumn("_bounds", F.lit(0))
        edges = F.array(*[F.lit(float(b)) for b in bounds])
        for _ in range(math.ceil(math.log2(len(bounds) + 1))):  # halving: one comparison a step
            middle = F.shiftright(low + high, 1)
            right = (F.get(edges, middle) <= F.col("_key").cast("double")) & (low < high)
            held = held.withColumn("_low", F.when(right, middle + 1).otherwise(low)).withColumn(
                "_high", F.when(right | (low >= high), high).otherwise(middle))
            low, high = F.col("_low"), F.col("_high")
        held = held.drop("_bounds")
    held = held.withColumn("_range", low.cast("int"))
    if heavy:
        own = held.sparkSession.createDataFrame([(int(k), int(r)) for k, r in heavy], "_key long, _own int")
        held = held.join(F.broadcast(own), "_key", "left").withColumn("_range", F.coalesce("_own", "_range")).drop("_own")
    return held.drop("_low", "_high")


def _cut_up(rows: DataFrame, cuts: Sequence[tuple[int, int]], first_heavy: int, key: str) -> DataFrame:
    """Adds ``_piece``: rows of an overfull range are dealt by a hash of their text, those of a heavy key by their id."""
    if not cuts:
        return rows.withColumn("_piece", F.lit(0))
    table = rows.sparkSession.createDataFrame([(int(r), int(n)) for r, n in cuts], "_range int, _parts int")
    by_text, by_id = F.xxhash64(F.lit("cut"), "_key"), F.xxhash64(F.lit("cut"), "_key", key)
    turn = F.when(F.col("_range") >= first_heavy, by_id).otherwise(by_text)
    return rows.join(F.broadcast(table), "_range", "left").withColumn(
        "_piece", F.coalesce(F.pmod(turn, F.col("_parts")), F.lit(0)).cast("int")).drop("_parts")


def pack(pieces: Sequence[tuple[int, int, int]], shards: int) -> list[tuple[int, int, int]]:
    """(range, piece, shard): the largest pieces first, each into the shard with the fewest bytes so far."""
    heap = [(0, s) for s in range(shards)]
    out = []
    for r, p, size in sorted(pieces, key=lambda x: (-x[2], x[0], x[1])):
        filled, shard = heapq.heappop(heap)
        heapq.heappush(heap, (filled + size, shard))
        out.append((r, p, shard))
    return sorted(out)


def plan(rows: DataFrame, shards: int, *, key: str = "doc_id") -> Plan:
    """The plan for ``rows`` (key, _key, size), which are read several times and should be materialized.

    A key whose records exceed a range's share of bytes has a range of its own, found exactly by one aggregate.
    Ranges that hold more than their share are cut into as many pieces as shares; then pieces are packed.
    """
    ranges = shards * RANGES
    n, total = rows.agg(F.count(F.lit(1)), F.sum("size")).first()
    total = total or 0
    unit = max(1, total // ranges)
    heavy_rows = rows.groupBy("_key").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > unit).collect()  # below ``ranges`` keys
    bounds = splitters(rows, total, ranges, key)
    first_heavy = len(bounds) + 1
    heavy = [(k, first_heavy + i) for i, k in enumerate(sorted(r["_key"] for r in heavy_rows))]
    ranged = _ranged(rows, bounds, heavy)
    filled = ranged.groupBy("_range").agg(F.sum("size").alias("bytes")).collect()
    cuts = [(r["_range"], math.ceil(r["bytes"] / unit)) for r in filled if r["bytes"] > unit]
    sums = _cut_up(ranged, cuts, first_heavy, key).groupBy("_range", "_piece").agg(F.sum("size").alias("bytes")).collect()
    packed = pack([(r["_range"], r["_piece"], r["bytes"]) for r in sums], shards)
    return Plan(shards, bounds, heavy, sorted(cuts), packed, max(1, -(-n // (shards * CELL_ROWS))))


def place(rows: DataFrame, made: Plan, *, key: str = "doc_id") -> DataFrame:
    """Adds ``shard`` to rows with _key and size; a function of key and id alone, so any rows of the table can be placed."""
    held = _cut_up(_ranged(rows, made.splitters, made.heavy), made.cuts, len(made.splitters) + 1, key)
    table = rows.sparkSession.createDataFrame(made.pieces or [(0, 0, 0)], "_range int, _piece int, shard int")
    return held.join(F.broadcast(table), ["_range", "_piece"], "left").withColumn("shard", F.coalesce("shard", F.lit(0))).drop("_range", "_piece")


def numbered(placed: DataFrame, made: Plan, *, key: str = "doc_id") -> DataFrame:
    """Adds ``slot``: 0, 1, 2, ... within each shard, by cells of about CELL_ROWS rows.

    A cell is a hash of id and text, so only rows equal in both must share one.
    """
    held = placed.withColumn("_cell", F.pmod(F.xxhash64(F.lit("cell"), key, "_key"), F.lit(made.cells)).cast("int"))
    counts = held.groupBy("shard", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)  # one row per cell
    offsets = counts.select("shard", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inner = F.row_number().over(Window.partitionBy("shard", "_cell").orderBy(key, "_key", "text_crc32")) - 1
    return held.withColumn("_inner", inner).join(offsets, ["shard", "_cell"]).withColumn(
        "slot", F.col("_before") + F.col("_inner")).drop("_cell", "_inner", "_before")


def assign(docs: DataFrame, shards: int = 8, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's shard and slot: the key, size, text_crc32, law (``bytes``), shard, slot, grown_shard (null).

    Sizes of the shards are nearly equal: ranges are at most 1 / RANGES of a shard, and the largest are packed first,
    so shards differ by little more than one range or the largest document. Documents of equal text stay in one shard unless together
    they exceed a range, in which case they are dealt by id. Shards depend on the rows alone, not on partitioning;
    ``slot`` is gapless from 0 in each shard.

    A null text is empty (size 1); null and repeated ids are rows like others; an empty table gives an empty
    result; other columns are not read. Texts are read once; keys and sizes are written to the shared folder.
    """
    rows = cut(sized(docs.select(F.col(key), F.col(text).alias("text"))).drop("text"))
    made = plan(rows, shards, key=key)
    return numbered(place(rows, made, key=key), made, key=key).select(
        key, "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write(docs: DataFrame, folder: str, shards: int = 8, *, key: str = "doc_id", text: str = "text", file_bytes: int = 1 << 28) -> Plan:
    """Writes whole documents as Parquet files below ``folder``/shard=n, about ``file_bytes`` each, and returns the plan.

    The plan's splitters place rows wherever they are, so texts are shuffled once and joined with nothing but bounded tables. Columns keep
    their names; a column named shard, or one starting with _key, size or text_crc32, is refused. Null and repeated rows are written.
    """
    if clash := {"shard", "size", "text_crc32", "_key", "_file"} & set(docs.columns):
        raise ValueError(f"columns of the plan: {sorted(clash)}")
    rows = cut(sized(docs.select(F.col(key), F.col(text).alias("text"))).drop("text"))
    made = plan(rows, shards, key=key)
    files = max(1, math.ceil((rows.agg(F.sum("size")).first()[0] or 0) / shards / file_bytes))
    placed = place(sized(docs, text), made, key=key).withColumn("_file", F.pmod(F.xxhash64(F.lit("file"), key, "_key"), F.lit(files)))
    placed.repartition(shards * files, "shard", "_file").select(*docs.columns, "shard").write.mode("errorifexists").partitionBy("shard").parquet(folder)
    return made
