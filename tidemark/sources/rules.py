"""Rule tables and configuration. Every reader attaches an ordinal, since earlier or later rows win."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.text import filled, is_enabled, normalize_name
from tidemark.operators.common import last_wins

ALIAS = "enabled string, playlist_name string, playlist_tvg_id string, provider_group string, region string, source string, source_id string, hard_pin string, notes string"
ID_FIX = "enabled string, playlist_name string, old_tvg_id string, new_tvg_id string, reason string"
OFFSET = "enabled string, source string, source_id string, offset_minutes string, notes string"
OVERRIDE = "enabled string, playlist_name string, source_id string, status string, reason string, evidence_url string"


def _ordered(df: DataFrame) -> DataFrame:
    """Rule files are small and read by one task, so the order of rows is their order in the file."""
    return df.coalesce(1).withColumn("ord", F.monotonically_increasing_id())


def read_rules(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows with as many columns as the header; others are left out. A missing file has no rows."""
    bad = "_corrupt string"
    reader = spark.read.option("header", True).option("encoding", "UTF-8").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").option("enforceSchema", True)
    try:
        raw = _ordered(reader.schema(f"{schema}, {bad}").csv(path))
    except AnalysisException:
        return spark.createDataFrame([], f"{schema}, ord bigint")
    return raw.where(F.col("_corrupt").isNull()).drop("_corrupt")


def read_aliases(spark: SparkSession, alias_path: str, pin_path: str) -> DataFrame:
    """Aliases, then pins: ord, name, source, grp, region, target_id, hard_pin."""
    a, p = read_rules(spark, alias_path, ALIAS), read_rules(spark, pin_path, ALIAS)
    both = a.withColumn("file", F.lit(0)).unionByName(p.withColumn("file", F.lit(1))).where(is_enabled(F.col("enabled")))
    ordinal = F.row_number().over(Window.orderBy("file", "ord")).cast("long")  # a rule file's rows, not data
    return both.select(ordinal.alias("ord"), filled(F.col("playlist_name")).alias("name"), filled(F.col("source")).alias("source"), filled(F.col("provider_group")).alias("grp"), filled(F.col("region")).alias("region"), filled(F.col("source_id")).alias("target_id"), "hard_pin")


def read_offsets(spark: SparkSession, path: str) -> DataFrame:
    """Enabled whole minutes of up to a week either way; `*` only as the last character."""
    r = read_rules(spark, path, OFFSET).where(is_enabled(F.col("enabled"))).withColumn("offset_minutes", F.col("offset_minutes").try_cast("int"))
    return r.where((F.abs("offset_minutes") <= 7 * 24 * 60) & ~F.rlike("source_id", F.lit(r"\*."))).select("ord", filled(F.col("source")).alias("source"), filled(F.col("source_id")).alias("source_id"), "offset_minutes")


def read_feeds(spark: SparkSession, path: str) -> DataFrame:
    """A list of feeds, or an object with `sources` or `items`; several names of a setting are known. source_index is the place in the list."""
    item = "struct<url:string,xmltv:string,epg_url:string,name:string,id:string,enabled:boolean,groups:array<string>,group_scope:array<string>,regions:array<string>,region_scope:array<string>,require_region_for_id:boolean>"
    text = spark.read.text(path, wholetext=True).select(F.trim("value").alias("v"))
    listed = F.from_json(F.when(F.startswith("v", F.lit("[")), F.concat(F.lit('{"sources":'), F.col("v"), F.lit("}"))).otherwise(F.col("v")), f"struct<sources:array<{item}>,items:array<{item}>>")
    rows = text.select(F.posexplode(F.coalesce(listed["sources"], listed["items"])).alias("source_index", "x"))
    none = F.array().cast("array<string>")
    pick = lambda *names: F.coalesce(*[F.nullif(F.trim(F.col(f"x.{n}")), F.lit("")) for n in names])
    return rows.where(F.coalesce("x.enabled", F.lit(True))).select(
        "source_index", pick("url", "xmltv", "epg_url").alias("url"), F.coalesce(pick("name", "id"), F.concat(F.lit("source-"), F.col("source_index").cast("string"))).alias("name"),
        F.coalesce("x.groups", "x.group_scope", none).alias("groups"), F.coalesce("x.regions", "x.region_scope", none).alias("regions"), F.coalesce("x.require_region_for_id", F.lit(False)).alias("require_region_for_id"),
    )


def read_title_aliases(spark: SparkSession, path: str) -> DataFrame:
    """norm, aliases: search hints from {canonical: [aliases]} (or under `aliases`), without those that are equal to it."""
    text = spark.read.text(path, wholetext=True).select(F.trim("value").alias("v"))
    inner = F.coalesce(F.get_json_object("v", "$.aliases"), F.col("v"))
    rows = text.select(F.explode(F.from_json(inner, "map<string,string>")).alias("canonical", "raw"))
    listed = F.coalesce(F.from_json("raw", "array<string>"), F.array("raw"))
    other = F.filter(F.array_distinct(F.transform(listed, lambda x: F.trim(x))), lambda x: (x != "") & (normalize_name(x) != normalize_name(F.col("canonical"))))
    return rows.select(normalize_name(F.col("canonical")).alias("norm"), other.alias("aliases")).where(F.size("aliases") > 0)


def read_metadata_rules(spark: SparkSession, path: str) -> DataFrame:
    """rule_ord, id, title_base, min_minutes, needles, year, imdb_id, imdb_rating, genres, description of enabled rules."""
    item = "struct<id:string,enabled:boolean,title_base:string,min_duration_minutes:int,channel_name_contains_any:array<string>,year:string,imdb_id:string,imdb_rating:string,genres:array<string>,description:string>"
    text = spark.read.text(path, wholetext=True)
    rules = F.coalesce(F.from_json("value", f"struct<rules:array<{item}>>")["rules"], F.from_json("value", f"array<{item}>"))
    rows = text.select(F.posexplode(rules).alias("rule_ord", "x")).where(F.coalesce("x.enabled", F.lit(True)))
    none = F.array().cast("array<string>")
    return rows.select("rule_ord", "x.id", "x.title_base", F.coalesce("x.min_duration_minutes", F.lit(0)).alias("min_minutes"), F.coalesce("x.channel_name_contains_any", none).alias("needles"), "x.year", "x.imdb_id", "x.imdb_rating", F.coalesce("x.genres", none).alias("genres"), "x.description")


def read_watchlist(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.text(path, wholetext=True)
    names = F.coalesce(F.from_json("value", "struct<channels:array<string>>")["channels"], F.from_json("value", "array<string>"))
    return text.select(F.explode(names).alias("n")).select(F.trim("n").alias("name")).where("name != ''").distinct()


def id_fixes(rows: DataFrame) -> DataFrame:
    return last_wins(rows.where(is_enabled(F.col("enabled"))), ["playlist_name"], "ord").select("playlist_name", "new_tvg_id")
