"""Sharding by sampled splitters: shards of near equal bytes that keep equal texts together.

The key of a record is the CRC-32 of its text. A size-weighted sample of keys gives quantile boundaries, which cut the
records into many ranges. Exact byte sums of the ranges show which are overfull. In these, the bytes of each single key are
summed too: a key that is overfull by itself (a text copied very often) becomes a range of its own, subdivided by a hash of
the rest of the record, and what is left of the range is subdivided by key. Prefix sums over the ranges, and inside each,
give every record its place in bytes; the shard is where its middle falls. All records of a key go where the middle of the
key's bytes falls, so equal texts share a shard; only those of a key that is overfull by itself (more than `limit`: 1/100
of a shard, or twice a range's bytes if that is more) are placed one by one, in a row, so that shards stay near equal.

The boundaries are a table, found by equi-joins on the key's upper bits: the plan doesn't grow with their number. Built from
DataFrame functions only; no window spans more than one subdivided range, but for one row a range.

Cases: null text: no bytes, CRC 0, and still size 8. Null doc_id: like any other value. Repeated rows: neighbours. Empty
table: empty result. Further columns are carried along by `shard`; its own columns replace those of the same name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from tidemark.llm.scale import before, chunk_offsets, materialize

ROW_BYTES = 8
SAMPLES_PER_RANGE = 16
#: Least ranges, for each shard, and bytes of a range beyond that many.
LEAST_RANGES, RANGES_PER_SHARD, RANGE_BYTES = 1024, 200, 256 << 20


def _keyed(docs: DataFrame) -> DataFrame:
    """_row (all columns but text), text, size, crc, and a hash of all of the row that can be hashed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = [F.col(f"`{f.name}`") for f in docs.schema.fields if f.name != "text" and not isinstance(f.dataType, MapType | ArrayType | StructType | VariantType)]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    return docs.select(row.alias("_row"), "text", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text.cast("binary")).cast("long").alias("crc"), F.xxhash64(F.lit(5), *plain).alias("id"))


def _share(key) -> F.Column:
    """A 64-bit number's place in [0, 1), in unsigned order."""
    return F.shiftrightunsigned(key, 11).cast("double") / float(1 << 53)


def splitters(keyed: DataFrame, n_ranges: int, total: int, bits: int) -> DataFrame:
    """cell (the key's upper `bits` bits), base, at: how many boundaries lie before the cell, and those in it, in order.

    About SAMPLES_PER_RANGE * n_ranges keys are drawn by size; every SAMPLES_PER_RANGE-th of them in order is a boundary.
    """
    spark = keyed.sparkSession
    drawn = keyed.where(_share("id") * total < F.col("size") * SAMPLES_PER_RANGE * n_ranges).groupBy("crc").agg(F.count("*").alias("n"))
    drawn = materialize(drawn.withColumn("cell", F.shiftright("crc", 32 - bits).cast("int")), "shard-sample")
    sums = chunk_offsets(drawn.groupBy("cell").agg(F.sum("n").alias("n")), [], ["cell"], {"n": "earlier"}).drop("n")
    # ranks of a key's first and last draw; a boundary where a multiple lies between them
    last = F.col("earlier") + F.sum("n").over(Window.partitionBy("cell").orderBy("crc"))
    ranked = drawn.join(sums, "cell").withColumn("last", last)
    met = F.floor(F.col("last") / SAMPLES_PER_RANGE) > F.floor((F.col("last") - F.col("n")) / SAMPLES_PER_RANGE)
    bounds = ranked.where(met).groupBy("cell").agg(F.sort_array(F.collect_list("crc")).alias("at"))
    cells = spark.range(1 << bits).select(F.col("id").cast("int").alias("cell")).join(bounds, "cell", "left").select("cell", F.coalesce("at", F.array().cast("array<bigint>")).alias("at"))
    return materialize(chunk_offsets(cells.withColumn("n", F.size("at").cast("long")), [], ["cell"], {"n": "base"}).drop("n"), "shard-splitters")


def _in_units(keyed: DataFrame, n_ranges: int, total: int, limit: int) -> DataFrame:
    """keyed with `unit`: struct<range, hot (the key that fills a range by itself, else -1), part>."""
    bits = min(24, max(4, (n_ranges - 1).bit_length()))
    cells = splitters(keyed, n_ranges, total, bits)
    ranged = keyed.withColumn("cell", F.shiftright("crc", 32 - bits).cast("int")).join(cells, "cell")
    ranged = ranged.withColumn("range", (F.col("base") + F.size(F.filter("at", lambda b: b <= F.col("crc")))).cast("long")).drop("cell", "base", "at")
    full = materialize(ranged.groupBy("range").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > limit).select("range", "bytes"), "shard-overfull")
    by_key = ranged.join(full.select("range"), "range", "left_semi").groupBy("range", "crc").agg(F.sum("size").alias("bytes"))
    hot = materialize(by_key.where(F.col("bytes") > limit).select("range", "crc", F.ceil(F.col("bytes") / limit).cast("int").alias("hot_parts"), "bytes"), "shard-hot")
    # what is left of an overfull range, and where its keys lie
    rest = by_key.join(hot.select("crc"), "crc", "left_anti").groupBy("range").agg(F.min("crc").alias("low"), F.max("crc").alias("high"), F.ceil(F.sum("bytes") / limit).cast("int").alias("parts"))
    rest = materialize(rest, "shard-rest")
    spread = ranged.join(hot.select("crc", "hot_parts"), "crc", "left").join(rest, "range", "left")
    is_hot = F.col("hot_parts").isNotNull()
    by_place = F.least(F.floor((F.col("crc") - F.col("low")) * F.col("parts") / (F.col("high") - F.col("low") + 1)), F.col("parts") - 1)
    part = F.when(is_hot, F.floor(_share("id") * F.col("hot_parts"))).otherwise(F.coalesce(by_place, F.lit(0)))
    unit = F.struct("range", F.when(is_hot, F.col("crc")).otherwise(-1).alias("hot"), part.cast("int").alias("part"))
    return spread.select(*keyed.columns, unit.alias("unit"))


def shard(docs: DataFrame, n_shards: int = 24, n_ranges: int | None = None) -> DataFrame:
    """docs with shard, slot (gapless from 0 in each shard), shard_bytes (size) and shard_key (CRC-32 of the text).

    n_ranges: by default RANGES_PER_SHARD for each shard, LEAST_RANGES at least, and one for each RANGE_BYTES.
    """
    keyed = _keyed(docs)
    total = max(1, keyed.agg(F.sum("size")).first()[0] or 0)
    n_ranges = n_ranges or max(LEAST_RANGES, RANGES_PER_SHARD * n_shards, total // RANGE_BYTES)
    placed = _in_units(keyed, n_ranges, total, max(1, 2 * total // n_ranges))
    sums = placed.groupBy("unit").agg(F.sum("size").alias("bytes"))
    bases = materialize(chunk_offsets(sums, [], ["unit"], {"bytes": "unit_base"}).drop("bytes"), "shard-bases")
    order = ["crc", F.shiftrightunsigned("id", 1), "id", "size"]
    size = F.col("size")
    placed = placed.withColumn("earlier", before(size, ["unit"], order)).join(bases, "unit")
    group = Window.partitionBy("unit", "crc")
    middle = F.when(F.col("unit.hot") < 0, F.min("earlier").over(group) + F.sum(size).over(group) / 2).otherwise(F.col("earlier") + size / 2)
    placed = placed.withColumn("to", F.least(F.floor((F.col("unit_base") + middle) * n_shards / total), F.lit(n_shards - 1)).cast("int"))
    placed = placed.withColumn("nth", F.row_number().over(Window.partitionBy("unit", "to").orderBy(*order)) - 1)
    counts = placed.groupBy("to", "unit").agg(F.count("*").alias("n"))
    slots = materialize(chunk_offsets(counts, ["to"], ["unit"], {"n": "first"}).drop("n"), "shard-slots")
    out = placed.join(slots, ["unit", "to"])
    columns = [(F.col("text") if c == "text" else F.col("_row").getField(c)).alias(c) for c in docs.columns if c not in ("shard", "slot", "shard_bytes", "shard_key")]
    return out.select(*columns, F.col("to").alias("shard"), (F.col("first") + F.col("nth")).cast("long").alias("slot"), F.col("size").alias("shard_bytes"), F.col("crc").alias("shard_key"))
