"""Reference datasets, legacy caches and state, and the table sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import filled, imdb_id, votes
from tidemark.operators.common import last_wins
from tidemark.operators.guide import gate_header

BASICS = ["tconst", "titleType", "primaryTitle", "originalTitle", "isAdult", "startYear", "endYear", "runtimeMinutes", "genres"]
RATINGS = ["tconst", "averageRating", "numVotes"]


def _tsv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    df = spark.read.csv(path, sep="\t", header=True, quote="", nullValue="\\N")
    gate_header(df, columns)
    # file and position order rows of one id
    return df.where(F.rlike("tconst", F.lit(r"^tt\d{5,12}$"))).withColumn("ord", F.monotonically_increasing_id())


def read_basics(spark: SparkSession, path: str) -> DataFrame:
    df = _tsv(spark, path, BASICS)
    whole = lambda c: F.col(c).try_cast("int").alias(c)
    return df.select("ord", "tconst", filled(F.col("titleType")).alias("titleType"), filled(F.col("primaryTitle")).alias("primaryTitle"), filled(F.col("originalTitle")).alias("originalTitle"), whole("startYear"), whole("endYear"), whole("runtimeMinutes"), F.filter(F.split(filled(F.col("genres")), ","), lambda g: g != "").alias("genres"))


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    df = _tsv(spark, path, RATINGS)
    return df.select("ord", "tconst", filled(F.col("averageRating")).alias("averageRating"), votes(F.col("numVotes")).alias("numVotes")).where("numVotes IS NOT NULL")


def read_title_cache(spark: SparkSession, path: str) -> DataFrame:
    """Legacy title cache: {schema, entries: {`norm|year|type|lang`: entry}} or the bare map. Before schema 8 only finds with an id count."""
    entry = "struct<status:string,imdb_id:string,title:string,overview:string,confidence:int,miss_count:int,cached_at:string>"
    text = spark.read.text(path, wholetext=True)
    schema = F.coalesce(F.get_json_object("value", "$.schema").try_cast("int"), F.lit(0))
    rows = text.select(schema.alias("schema"), F.explode(F.from_json(F.coalesce(F.get_json_object("value", "$.entries"), F.col("value")), f"map<string,{entry}>")).alias("key", "e"))
    part = F.split("key", r"\|", 4)
    field = lambda k: F.coalesce(F.get(part, F.lit(k)), F.lit(""))
    keep = (F.col("schema") >= 8) | ((F.col("e.status") == "found") & (imdb_id(F.col("e.imdb_id")) != ""))
    return rows.where(keep & F.col("e").isNotNull()).select(field(0).alias("norm"), field(1).alias("year"), field(2).alias("media"), field(3).alias("language"), "e.*")


def read_entity_cache(spark: SparkSession, path: str) -> DataFrame:
    """Legacy entities by id; the source label follows from what they have."""
    entry = "struct<rating:string,votes:string,title:string,overview:string,checked_at:string>"
    text = spark.read.text(path, wholetext=True)
    rows = text.select(F.explode(F.from_json(F.coalesce(F.get_json_object("value", "$.entities"), F.col("value")), f"map<string,{entry}>")).alias("id", "e"))
    rows = rows.select(imdb_id(F.col("id")).alias("imdb_id"), "e.*").where("imdb_id != ''").withColumn("votes", votes(F.col("votes")))
    return rows.withColumn("source", F.when(filled(F.col("rating")) != "", "imdb-dataset").otherwise("unknown"))


def read_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of an earlier run; none where there is nothing yet or it can't be read."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """The columns in order, blank where a column is missing or null."""
    own = [filled(F.col(c)).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns]
    df.select(*own).write.mode("overwrite").csv(path, header=True)


def write_document(df: DataFrame, path: str) -> None:
    """One JSON row for each row of df: status and reports are single nested rows."""
    df.write.mode("overwrite").json(path)


def delivery_map(mapping: DataFrame) -> DataFrame:
    """playlist_name -> output_tvg_id for delivery; the last row of a name counts and no addresses leave."""
    return last_wins(mapping.select("ord", "playlist_name", "output_tvg_id"), ["playlist_name"], "ord").select("playlist_name", "output_tvg_id")


def append_run(df: DataFrame, path: str, run_id: str) -> None:
    """History is a table by run; a run's partition is written whole, so a repeated run replaces itself."""
    df.withColumn("run_id", F.lit(run_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(path)
