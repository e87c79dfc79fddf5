"""Document fingerprints: SimHash over weighted term hashes, and a search by permuted block tables."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from triagelake.core import shuffle_partitions
from triagelake.llm.common import WORD, text_of

WORDS = 5
#: Two 64-bit halves; a sum holds two counters of 32 bits each.
HALVES = 2
LANES = 0x0000000100000001


def terms(text: Column) -> Column:
    """Hashes of the words of a text, in order. The terms that vote are its five-word shingles (a shorter
    text is one term).

    Every occurrence of a shingle is an element, so a term's weight is how often it occurs.
    """
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))


def _zipped(hashes: Column) -> Column:
    n = F.size(hashes)
    count = F.greatest(n - (WORDS - 1), F.least(n, F.lit(1)))
    return F.slice(F.arrays_zip(*[
        (hashes if k == 0 else F.slice(hashes, k + 1, F.greatest(n, F.lit(1)))).alias(f"w{k}") for k in range(WORDS)]), 1, count)


def votes(rows: DataFrame, keys: list[str], hashes: str = "_words") -> DataFrame:
    """``keys``, and the halves a and b of the fingerprint of each row; ``keys`` name a row and its place.

    A bit is set if more than half of the weight votes for it. Each of the 32 sums of a half counts two bits
    at once, so a text may have up to 2^32 shingles. A text without words has all bits clear.
    """
    spread = rows.select(*keys, F.explode_outer(_zipped(F.col(hashes))).alias("_t"))
    columns = [F.col("_t")[f"w{k}"] for k in range(WORDS)]
    hashed = spread.select(*keys, *[
        F.when(columns[0].isNotNull(), F.xxhash64(F.lit(half), *columns)).alias(f"_h{half}") for half in range(HALVES)])
    sums = [F.sum(F.shiftright(f"_h{half}", i).bitwiseAND(F.lit(LANES))).alias(f"_s{half}_{i}") for half in range(HALVES) for i in range(32)]
    counted = hashed.groupBy(*keys).agg(F.count("_h0").alias("_n"), *sums)

    def half_of(half: int) -> Column:
        bits = []
        for i in range(32):
            pair = F.coalesce(F.col(f"_s{half}_{i}"), F.lit(0))
            for shift, votes_ in ((i, pair.bitwiseAND(F.lit(0xFFFFFFFF))), (i + 32, F.shiftrightunsigned(pair, 32))):
                bits.append(F.shiftleft((2 * votes_ > F.col("_n")).cast("long"), shift))
        return reduce(lambda x, y: x.bitwiseOR(y), bits)

    return counted.select(*keys, half_of(0).alias("a"), half_of(1).alias("b"))


def shown(a: Column, b: Column) -> Column:
    """The fingerprint as 32 hexadecimal digits."""
    return F.lower(F.concat(F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0")))


def distance(a: Column, b: Column, other_a: Column, other_b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(other_a)) + F.bit_count(b.bitwiseXOR(other_b))


def likeness(a: Column, b: Column, other_a: Column, other_b: Column) -> Column:
    return 1.0 - distance(a, b, other_a, other_b) / float(64 * HALVES)


def fingerprint(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, a, b) of every whole text; equal texts have equal fingerprints.

    Null texts have no words; null keys and repeated rows keep their rows; other columns are not read.
    """
    rows = docs.select(F.col(key).alias("doc_id"), terms(text_of(text)).alias("_words"), F.monotonically_increasing_id().alias("_row"))
    return votes(rows, ["doc_id", "_row"]).drop("_row")


def _with_next(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows (block, guest, key, doc_id, text): id-ordered blocks, each with the first row of the block behind it.

    Blocks come from quantiles of the ids; the first row of a block is also sent, as a guest, to the block
    before it in descending order (that of the first block to the last), so whatever needs a row and
    the next finds both in one block. One row per block goes to the driver.
    """
    place = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), text_of(text).alias("text")).withColumn("_key", place)
    rows = rows.withColumn("_double", F.col("_key").cast("double"))
    parts = 4 * shuffle_partitions(docs)
    bounds = rows.approxQuantile("_double", [i / parts for i in range(1, parts)], 1 / (4 * parts))
    splits = [float("-inf"), *(sorted(set(bounds)) or [0.0]), float("inf")]
    cutter = Bucketizer(splits=splits, inputCol="_double", outputCol="_block", handleInvalid="keep")
    blocked = cutter.transform(rows).withColumn("_block", F.col("_block").cast("int")).drop("_double")
    tops = sorted(((r["_block"], r["top"]) for r in blocked.groupBy("_block").agg(F.max("_key").alias("top")).collect()), reverse=True)
    sent = [(block, top, tops[i - 1][0]) for i, (block, top) in enumerate(tops)] or [(0, 0, 0)]
    guests = docs.sparkSession.createDataFrame(sent, "_block int, _top long, _to int")
    own = F.struct(F.col("_block").alias("block"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("_to").alias("block"), F.lit(True).alias("guest"))
    both = F.when(F.col("_key") == F.col("_top"), F.array(own, guest)).otherwise(F.array(own))
    return blocked.join(F.broadcast(guests), "_block").select("doc_id", "text", "_key", F.explode(both).alias("_p")).select(
        "_p.block", "_p.guest", "_key", "doc_id", "text")


def with_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, a, b, edited_a, edited_b, near_edited, near_next.

    The edited text has the last half of the code points (rounded down) replaced by the first as many of
    the next document in descending order of id; null ids come last, equal ids are ordered by text, the
    first document follows the last. Texts are shuffled once, to id-ordered blocks of bounded size; both
    fingerprints and the comparison with the next document are computed within the block. A null text is
    empty; an empty table gives an empty result.
    """
    placed = _with_next(docs, key, text)
    order = Window.partitionBy("block").orderBy("guest", F.col("_key").desc(), F.xxhash64("text"), "text")
    rows = placed.select("block", "guest", "doc_id", "text", F.row_number().over(order).alias("rn"), F.lead("text").over(order).alias("_next"))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("_next", F.lit(1), half))
    rows = rows.select("block", "rn", "guest", "doc_id", n.cast("long").alias("n_chars"), "text",
                       F.when(~F.col("guest"), edited).alias("_edited"))
    version = lambda v, t: F.struct(F.lit(v).alias("v"), t.alias("text"))
    rows = rows.withColumn("_sha", F.unhex(F.sha2(F.col("_edited"), 256))).withColumn("_v", F.explode(
        F.filter(F.array(version(0, F.col("text")), version(1, F.col("_edited"))), lambda x: x["text"].isNotNull())))
    keys = ["block", "rn", "guest", "doc_id", "n_chars", "_sha", "v"]
    hashed = rows.select("block", "rn", "guest", "doc_id", "n_chars", "_sha", F.col("_v")["v"].alias("v"), terms(F.col("_v")["text"]).alias("_words"))
    marks = votes(hashed, keys)
    pick = lambda v, c: F.max(F.when(F.col("v") == v, F.col(c)))
    paired = marks.groupBy(*keys[:-1]).agg(
        pick(0, "a").alias("a"), pick(0, "b").alias("b"), pick(1, "a").alias("edited_a"), pick(1, "b").alias("edited_b"))
    following = Window.partitionBy("block").orderBy("rn")
    paired = paired.withColumn("_na", F.lead("a").over(following)).withColumn("_nb", F.lead("b").over(following)).where(~F.col("guest"))
    col = F.col
    return paired.select(
        "doc_id", "n_chars", F.lower(F.hex("_sha")).alias("edited_sha256"), "a", "b", "edited_a", "edited_b",
        likeness(col("a"), col("b"), col("edited_a"), col("edited_b")).alias("near_edited"),
        likeness(col("a"), col("b"), col("_na"), col("_nb")).alias("near_next"))


def search(queries: DataFrame, table: DataFrame, radius: int = 3) -> DataFrame:
    """(query_a, query_b, a, b, distance): the distinct fingerprints of ``table`` within ``radius`` bits.

    Fingerprints are cut into radius + 1 blocks; two within the radius agree in one of them at least, so there is
    a table for each block, with that block moved to the front as the key. A pair is taken from the first
    table that holds it. Equal fingerprints are one entry: join back on (a, b) for the documents.

    Both inputs need the columns a and b alone; rows with a null in them match nothing, repeated ones count once, and an empty side gives
    an empty result. Many different fingerprints that share a block are compared in pairs of that block.
    """
    width = 64 * HALVES
    cuts = [round(i * width / (radius + 1)) for i in range(radius + 2)]

    def block(i: int) -> Column:
        parts = []
        for half, name in enumerate(("a", "b")):
            low, high = max(cuts[i], 64 * half), min(cuts[i + 1], 64 * half + 64)
            if low < high:
                mask = (1 << (high - low)) - 1
                part = F.shiftrightunsigned(name, low - 64 * half)
                parts.append(part if high - low == 64 else part.bitwiseAND(F.lit(mask)))
        return F.xxhash64(*parts) if len(parts) > 1 else parts[0]

    def tables(df: DataFrame) -> DataFrame:
        entries = F.array(*[F.struct(F.lit(i).alias("t"), block(i).alias("key")) for i in range(radius + 1)])
        return df.select("a", "b").distinct().select("a", "b", F.explode(entries).alias("_e")).select("a", "b", "_e.t", "_e.key")

    left = tables(queries).select(F.col("a").alias("query_a"), F.col("b").alias("query_b"), "t", "key")
    found = left.join(tables(table), ["t", "key"]).withColumn(
        "distance", distance(F.col("query_a"), F.col("query_b"), F.col("a"), F.col("b"))).where(F.col("distance") <= radius)
    return found.select("query_a", "query_b", "a", "b", "distance").distinct()
