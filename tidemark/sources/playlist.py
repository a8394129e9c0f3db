"""M3U playlists: lines to channel rows, and rewritten playlists back to lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line_no, line. A playlist is read as one value, so its lines keep their numbers; files are read in parallel."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    return whole.select("file", F.posexplode(F.split(F.ltrim(F.col("value"), F.lit("﻿")), r"\r?\n")).alias("line_no", "line"))


def parse_m3u(lines: DataFrame) -> DataFrame:
    """file, channel_index, name, tvg_id, tvg_name, grp, extinf, stream_url.

    `#EXTINF` opens a record, and drops one that has no address yet; `#EXTGRP:` overrides the group; the first line that
    isn't blank or a comment closes it. The name is what follows the first comma, also in quotes and also if that is
    nothing; a line without a comma has the provider's name.
    """
    w = Window.partitionBy("file").orderBy("line_no")
    line = F.trim("line")
    marked = lines.withColumn("line", line).where("line != ''").withColumn("opens", F.startswith("line", F.lit("#EXTINF")).cast("int"))
    marked = marked.withColumn("block", F.sum("opens").over(w)).where("block > 0")
    address = ~F.startswith("line", F.lit("#"))
    # the first address closes the block: what comes after it, up to the next record, isn't its own
    closed = F.sum(F.when(address, 1).otherwise(0)).over(Window.partitionBy("file", "block").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1))
    own = marked.withColumn("_closed", F.coalesce(closed, F.lit(0))).where("_closed = 0")
    first = lambda cond, value: F.min_by(value, F.when(cond, F.col("line_no")))
    last = lambda cond, value: F.max_by(value, F.when(cond, F.col("line_no")))
    group_line = F.startswith("line", F.lit("#EXTGRP:"))
    blocks = own.groupBy("file", "block").agg(first(F.col("opens") == 1, F.col("line")).alias("extinf"), last(group_line, F.trim(F.substr("line", F.lit(9)))).alias("extgrp"), first(address, F.col("line")).alias("stream_url"))
    blocks = blocks.where("stream_url IS NOT NULL")
    pairs = F.zip_with(F.regexp_extract_all("extinf", F.lit(r'([\w-]+)="([^"]*)"'), F.lit(1)), F.regexp_extract_all("extinf", F.lit(r'([\w-]+)="([^"]*)"'), F.lit(2)), lambda k, v: F.struct(k.alias("k"), v.alias("v")))
    attr = lambda name: F.coalesce(F.element_at(F.filter(F.concat(F.array(F.struct(F.lit(name).alias("k"), F.lit("").alias("v"))), pairs), lambda x: x["k"] == name), -1)["v"], F.lit(""))
    after = F.trim(F.regexp_extract("extinf", r"^[^,]*,(.*)$", 1))
    out = blocks.select("file", "block", F.when(F.contains("extinf", F.lit(",")), after).otherwise(attr("tvg-name")).alias("name"), attr("tvg-id").alias("tvg_id"), attr("tvg-name").alias("tvg_name"), F.when(F.coalesce("extgrp", F.lit("")) != "", F.col("extgrp")).otherwise(attr("group-title")).alias("grp"), "extinf", "stream_url")
    return out.withColumn("channel_index", (F.row_number().over(Window.partitionBy("file").orderBy("block")) - 1).cast("long")).drop("block")


def playlist_lines(blocks: DataFrame, header: str = "#EXTM3U") -> DataFrame:
    """ord, line: the header, then three lines for each block (extinf, extgrp, url) in order. A block's lines are in one partition."""
    body = blocks.select(F.col("ord"), F.posexplode(F.array("extinf", "extgrp", "url")).alias("part", "value"))
    top = blocks.sparkSession.createDataFrame([(-1, 0, header)], "ord bigint, part int, value string")
    return top.unionByName(body.select(F.col("ord").cast("long").alias("ord"), "part", "value")).repartitionByRange("ord").sortWithinPartitions("ord", "part")


def write_playlist(blocks: DataFrame, path: str) -> None:
    """Text in order: files are ranges of whole blocks, so reading them by name gives the playlist, and each alone its own blocks."""
    playlist_lines(blocks).select("value").write.mode("overwrite").text(path)
