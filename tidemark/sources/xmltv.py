"""XMLTV guides: channels and programmes from XML, and back to XML.

Landed files are read as bytes: the first two say whether a file is compressed, whatever its name, and a task inflates it as
it goes; a guide that guide_file wrote is dealt out by members, so many tasks inflate and cut it. An element is kept as the text it is (`raw`), with what this package knows of it parsed beside it, so children that
nobody here knows of go through to the sink. Guides with `.gz` names can also be read by Spark's own XML reader.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import normalize_name
from tidemark.sources import guide_file

CHANNEL = "_id string, `display-name` array<string>"
PROGRAMME = (
    "_channel string, _start string, _stop string, title array<struct<_VALUE:string,_lang:string>>, desc string, category array<string>, date string, "
    "rating array<struct<_system:string,value:string>>, url array<string>, icon struct<_src:string>, `episode-num` array<string>"
)


def read_channels(spark: SparkSession, path: str, source_index: int) -> DataFrame:
    raw = spark.read.format("xml").option("rowTag", "channel").schema(CHANNEL).load(path)
    return raw.select(F.lit(source_index).alias("source_index"), F.trim("_id").alias("id"), F.coalesce("display-name", F.array().cast("array<string>")).alias("display_names")).where("id != ''")


def programme_columns(raw: DataFrame, *more: str) -> DataFrame:
    first = F.element_at(F.concat(F.coalesce("title", F.array().cast("array<struct<_VALUE:string,_lang:string>>")), F.array(F.struct(F.lit("").alias("_VALUE"), F.lit("").alias("_lang")))), 1)
    return raw.select(
        *more, F.trim("_channel").alias("channel"), F.col("_start").alias("start"), F.col("_stop").alias("stop"), F.trim(F.coalesce(first["_VALUE"], F.lit(""))).alias("title"), F.coalesce(first["_lang"], F.lit("")).alias("lang"),
        "desc", F.coalesce("category", F.array().cast("array<string>")).alias("categories"), "date", F.transform("rating", lambda r: F.struct(r["_system"].alias("system"), r["value"].alias("value"))).alias("rating"), "url", F.col("icon._src").alias("icon"), F.col("episode-num").isNotNull().alias("has_episode"),
    )


def read_programmes(spark: SparkSession, path: str, source_index: int) -> DataFrame:
    """Land this once as Parquet by source and date: XML can't skip rows, and a compressed guide is one task."""
    raw = spark.read.format("xml").option("rowTag", "programme").schema(PROGRAMME).load(path)
    return programme_columns(raw).withColumn("source_index", F.lit(source_index))


def land_programmes(programmes: DataFrame, path: str) -> None:
    programmes.withColumn("start_date", F.substring("start", 1, 8)).repartition("source_index", "start_date").write.mode("overwrite").partitionBy("source_index", "start_date").parquet(path)


def name_rows(channels: DataFrame) -> DataFrame:
    """source_index, id, norm: one row for each display name."""
    return channels.select("source_index", "id", F.explode("display_names").alias("n")).select("source_index", "id", normalize_name(F.col("n")).alias("norm")).where("norm != ''").distinct()


#: Bytes that are inflated at once, and compressed bytes that are handed over at once.
PIECE, FED = 1 << 20, 1 << 15
#: Compressed bytes of a slice of a guide, at least.
SLICE = 1 << 19
#: A compressed byte gives fewer elements: deflate makes at most 1032 bytes of one, and an element has 10 or more.
ELEMENTS = 128


def _inflated(content: bytes) -> Iterator[bytes]:
    """The text of a file by pieces; several compressed members after each other are one text. What is cut off or broken ends it."""
    if content[:2] != b"\x1f\x8b":
        for at in range(0, len(content), PIECE):
            yield content[at : at + PIECE]
        return
    view, at = memoryview(content), 0
    while content[at : at + 2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        while not member.eof and (at < len(content) or member.unconsumed_tail):
            rest = member.unconsumed_tail
            if not rest:
                rest = view[at : at + FED]
                at += len(rest)
            try:
                yield member.decompress(rest, PIECE)
            except zlib.error:
                return
        at -= len(member.unused_data)


def _dealer():
    """Whole files as slices: of a guide that guide_file wrote, members of SLICE bytes or more together, which hold whole elements; of any other file, all of it."""
    header, size = guide_file.HEADER, SLICE

    def deal(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                whole, at = content.as_py() or b"", 0
                while at < len(whole):
                    end = whole.find(header, at + size) if whole.startswith(header) else -1
                    end = len(whole) if end < 0 else end
                    yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([whole[at:end]], pa.binary()), pa.array([at], pa.int64())], ["path", "content", "at"])
                    at = end

    return deal


def _cutter():
    """The elements of whole files, or of slices with their places (`at`), as rows. Made in a function, so that it travels to the workers with the query."""
    element = re.compile(rb"<!--.*?-->|<(channel|programme)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*?(?:/>|>.*?</\1\s*>)", re.S)
    inflated, elements = _inflated, ELEMENTS

    def cut(batches):
        for batch in batches:
            places = batch.column(2).to_pylist() if batch.num_columns > 2 else [0] * batch.num_rows
            for path, content, at in zip(batch.column(0).to_pylist(), batch.column(1), places, strict=True):
                held, nth = b"", at * elements
                kinds, numbers, texts = [], [], []
                for piece in inflated(content.as_py() or b""):
                    held += piece
                    done = 0
                    for m in element.finditer(held):
                        done = m.end()
                        if m[1]:
                            kinds.append(m[1].decode())
                            numbers.append(nth)
                            texts.append(m[0].decode("utf-8", "replace"))
                            nth += 1
                    # what may still become an element starts at the first opening that is left
                    opening = re.search(rb"<(?:channel|programme)\b|<!--", held[done:])
                    held = held[done + opening.start() :] if opening else held[max(done, len(held) - 16) :]
                    if texts:
                        yield pa.RecordBatch.from_arrays([pa.array([path] * len(texts)), pa.array(kinds), pa.array(numbers, pa.int64()), pa.array(texts)], ["path", "kind", "nth", "raw"])
                        kinds, numbers, texts = [], [], []

    return cut


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    """path, kind (channel or programme), nth, raw, of all landed files, compressed or not.

    nth grows along a file; it counts its elements, but in a guide of several slices it leaves numbers out between them.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    slices = files.mapInArrow(_dealer(), "path string, content binary, at bigint").repartition("path", "at")
    return slices.mapInArrow(_cutter(), "path string, kind string, nth bigint, raw string")


def channels_of(elements: DataFrame, source_index: Column) -> DataFrame:
    """source_index, id, display_names, raw."""
    e = elements.where("kind = 'channel'").select("*", F.from_xml("raw", CHANNEL, {"rowTag": "channel"}).alias("x"))
    names = F.coalesce(F.col("x.display-name"), F.array().cast("array<string>"))
    return e.select(source_index.alias("source_index"), F.trim("x._id").alias("id"), names.alias("display_names"), "nth", "raw").where("id != ''")


def programmes_of(elements: DataFrame, source_index: Column) -> DataFrame:
    """source_index, what is known of a programme (as read_programmes), nth and raw."""
    e = elements.where("kind = 'programme'").select(source_index.alias("source_index"), "nth", "raw", F.from_xml("raw", PROGRAMME, {"rowTag": "programme"}).alias("x"))
    return programme_columns(e.select("source_index", "nth", "raw", "x.*"), "source_index", "nth", "raw")


def with_attribute(raw: Column, name: str, value: Column) -> Column:
    """The element with another value of an attribute that it has; as it is if the value is null."""
    opening = rf"(?s)^(<[^>]*?\s{name}\s*=\s*)(?:\"[^\"]*\"|'[^']*')"
    text = F.replace(F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    safe = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
    return F.coalesce(F.regexp_replace(raw, F.lit(opening), F.concat(F.lit('$1"'), safe, F.lit('"'))), raw)


def retimed(programmes: DataFrame, start: Column, stop: Column, channel: Column | None = None) -> DataFrame:
    """The programmes at other times (and on another channel), in their columns and in raw; all else in raw stays."""
    raw = with_attribute(with_attribute(F.col("raw"), "start", start), "stop", stop)
    raw = raw if channel is None else with_attribute(raw, "channel", channel)
    return programmes.withColumns({"raw": raw, "start": start, "stop": stop, **({} if channel is None else {"channel": channel})})


def _escaped(value: Column) -> Column:
    for plain, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        value = F.replace(value, F.lit(plain), F.lit(safe))
    return value


def with_child(raw: Column, tag: str, value: Column) -> Column:
    """The element with this text in its first child of that name, or in a new one at its end; as it is if the value is null or blank."""
    literal = F.replace(F.replace(_escaped(value), F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))
    there = rf"(?s)^(.*?<{tag}(?:\s[^>]*)?(?<!/)>).*?(</{tag}\s*>)"
    new = with_element(raw, F.concat(F.lit(f"<{tag}>"), _escaped(value), F.lit(f"</{tag}>")))
    return F.when(F.coalesce(F.trim(value), F.lit("")) == "", raw).when(F.rlike(raw, F.lit(there)), F.regexp_replace(raw, F.lit(there), F.concat(F.lit("$1"), literal, F.lit("$2")))).otherwise(new)


def with_element(raw: Column, element: Column) -> Column:
    """The programme with one more child at its end; as it is if the child is null."""
    closed = F.regexp_replace(raw, r"\s*/>\s*$", "></programme>")
    body = F.when(F.rlike(raw, F.lit(r"</programme\s*>\s*$")), raw).otherwise(closed)
    return F.coalesce(F.concat(F.regexp_replace(body, r"</programme\s*>\s*$", ""), element, F.lit("</programme>")), raw)


def rendered(programmes: DataFrame) -> DataFrame:
    """raw as the rendered columns have it (see enrich.render), where `found` isn't null: title, description, imdb rating, link, icon and images set, date and categories gone; all other children stay."""
    first = lambda values: F.element_at(F.concat(values, F.array(F.lit(None).cast("string"))), 1)
    ratings, images = F.coalesce("rating", F.array().cast("array<struct<system:string,value:string>>")), F.coalesce("image", F.array().cast("array<struct<type:string,src:string>>"))
    stars = first(F.transform(F.filter(ratings, lambda r: F.lower(F.trim(r["system"])) == "imdb"), lambda r: r["value"]))
    link = first(F.filter(F.coalesce("url", F.array().cast("array<string>")), lambda u: F.contains(F.lower(u), F.lit("imdb.com/title/"))))
    raw, own = F.col("raw"), r"(?is)(<rating\s[^>]*system\s*=\s*[\"']imdb[\"'][^>]*>\s*<value[^>]*>).*?(</value\s*>)"
    lacks = lambda text, element: F.when(~F.contains(raw, text), element)
    rated = F.when(F.rlike(raw, F.lit(own)), F.regexp_replace(raw, F.lit(own), F.concat(F.lit("$1"), stars, F.lit("$2")))).otherwise(with_element(raw, F.concat(F.lit('<rating system="IMDb"><value>'), stars, F.lit("</value></rating>"))))
    steps = [
        F.regexp_replace(raw, r"(?s)\s*<(date|category|country|length)\b(?:[^>]*/>|[^>]*>.*?</\1\s*>)", ""), with_child(raw, "title", F.col("title")), with_child(raw, "desc", F.col("desc")), F.when(stars.isNull(), raw).otherwise(rated),
        with_element(raw, lacks(F.lit("imdb.com/title/"), F.concat(F.lit("<url>"), _escaped(link), F.lit("</url>")))),
        with_element(raw, lacks(F.lit("<icon"), F.concat(F.lit('<icon src="'), F.replace(_escaped(F.nullif("icon", F.lit(""))), F.lit('"'), F.lit("&quot;")), F.lit('"/>')))),
    ]
    for kind, orient in (("poster", "P"), ("backdrop", "L")):
        src = first(F.transform(F.filter(images, lambda i, kind=kind: i["type"] == kind), lambda i: i["src"]))
        element = F.concat(F.lit(f'<image type="{kind}" size="3" orient="{orient}" system="tmdb">'), _escaped(src), F.lit("</image>"))
        steps.append(with_element(raw, lacks(F.concat(F.lit(">"), _escaped(src), F.lit("</image>")), element)))
    # a projection for each step: one expression of all of them would hold raw thousands of times
    for step in steps:
        programmes = programmes.withColumn("raw", F.when(F.col("found").isNull(), raw).otherwise(step))
    return programmes


def split_by_magic(spark: SparkSession, path: str) -> DataFrame:
    """path, is_gzip of every landed file, by its first two bytes."""
    return spark.read.format("binaryFile").load(path).select("path", (F.hex(F.substring("content", 1, 2)) == "1F8B").alias("is_gzip"))


def guide_elements(channels: DataFrame, programmes: DataFrame) -> DataFrame:
    """Both tables as elements for guide_file: kind, id, part, ord, xml. `raw` stands where it is given.

    channels: output_tvg_id, display_names[, raw]. programmes: channel, start, stop, title, desc, categories[, raw].
    """
    def text(df: DataFrame, tag: str, fields: Column) -> Column:
        made = F.to_xml(fields, {"rowTag": tag, "declaration": ""})
        return F.coalesce("raw", made) if "raw" in df.columns else made

    c = text(channels, "channel", F.struct(F.col("output_tvg_id").alias("_id"), F.col("display_names").alias("display-name")))
    p = text(programmes, "programme", F.struct(F.col("channel").alias("_channel"), F.col("start").alias("_start"), F.col("stop").alias("_stop"), "title", "desc", F.col("categories").alias("category")))
    first = channels.select(F.lit(0).alias("kind"), F.col("output_tvg_id").alias("id"), F.lit("").alias("part"), F.lit("").alias("at"), c.alias("xml"))
    return first.unionByName(programmes.select(F.lit(1).alias("kind"), F.col("channel").alias("id"), F.substring("start", 1, 6).alias("part"), F.col("start").alias("at"), p.alias("xml")))


def write_guide(channels: DataFrame, programmes: DataFrame, path: str) -> None:
    """One compressed guide: channels by id, then programmes by channel and start; equal tables give equal bytes (see guide_file)."""
    key = ["kind", "id", "part"]
    spark = channels.sparkSession
    spark.dataSource.register(guide_file.guide_format())
    guide_elements(channels, programmes).repartition(*key).sortWithinPartitions(*key, "at", "xml").write.format(guide_file.NAME).mode("overwrite").save(path)
