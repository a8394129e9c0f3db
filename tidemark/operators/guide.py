"""The guide: programmes for mapped channels, their clock corrections, counts, coverage and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timeparse import date_is_fresh, instant, is_usable, shift
from tidemark.operators.common import first_wins


def clock_offsets(ids: DataFrame, rules: DataFrame) -> DataFrame:
    """source, source_id, offset_minutes. An exact rule wins, even with 0; else the longest prefix ending in `*`; else 0.

    Prefixes are found by an equi-join on (source, length, leading characters): the lengths that rules of a source have
    are few, so an id is tried once for each length and no pair of all ids and rules is made.
    """
    r = rules.select(F.col("source").alias("r_source"), F.col("source_id").alias("pattern"), F.col("offset_minutes").alias("minutes"))
    exact = F.col("pattern").endswith("*")
    r = r.select("r_source", "minutes", (~exact).alias("is_exact"), F.when(exact, F.substr("pattern", F.lit(1), F.length("pattern") - 1)).otherwise(F.col("pattern")).alias("key"))
    lengths = r.where(~F.col("is_exact")).groupBy("r_source").agg(F.collect_set(F.length("key")).alias("lengths"))
    tried = ids.join(lengths, ids["source"] == lengths["r_source"], "left").drop("r_source")
    none = F.array().cast("array<int>")
    ways = F.concat(F.array(F.struct(F.lit(True).alias("is_exact"), F.col("source_id").alias("key"))), F.transform(F.coalesce("lengths", none), lambda n: F.struct(F.lit(False).alias("is_exact"), F.substr("source_id", F.lit(1), n).alias("key"))))
    tried = tried.select("source", "source_id", F.explode(F.array_distinct(ways)).alias("w")).select("source", "source_id", "w.*")
    met = tried.join(r, (tried["source"] == r["r_source"]) & (tried["is_exact"] == r["is_exact"]) & (tried["key"] == r["key"]), "left").select("source", "source_id", tried["is_exact"], tried["key"], "minutes")
    best = F.max_by("minutes", F.when(F.col("minutes").isNotNull(), F.struct("is_exact", F.length("key").alias("n"))))
    return met.groupBy("source", "source_id").agg(F.coalesce(best, F.lit(0)).alias("offset_minutes"))


def corrected(programmes: DataFrame, offsets: DataFrame) -> DataFrame:
    """Programmes (source, channel, start, stop as text) with clocks put right and their instants, before any freshness test."""
    o = offsets.select(F.col("source"), F.col("source_id").alias("channel"), "offset_minutes")
    p = programmes.join(o, ["source", "channel"], "left").withColumn("offset_minutes", F.coalesce("offset_minutes", F.lit(0)))
    p = p.withColumns({"start": shift(F.col("start"), F.col("offset_minutes")), "stop": shift(F.col("stop"), F.col("offset_minutes"))})
    return p.withColumns({"start_at": instant(F.col("start")), "stop_at": instant(F.col("stop"))})


def with_windows(programmes: DataFrame, now: Column, past: int = 5, future: int = 21) -> DataFrame:
    """Adds kept (in the archive's dates) and usable (on air soon). now: a timestamp without a zone."""
    return programmes.withColumns({"kept": date_is_fresh(F.col("start"), now.cast("date"), past, future), "usable": is_usable(F.col("start_at"), F.col("stop_at"), now)})


def usable_index(feed_ids: DataFrame, programmes: DataFrame) -> DataFrame:
    """Feed ids with at least one usable programme."""
    return feed_ids.join(programmes.where("usable").select("source_index", F.col("channel").alias("id")).distinct(), ["source_index", "id"], "left_semi")


def name_index(feed_channels: DataFrame) -> DataFrame:
    """source_index, norm, ids, n_ids: which ids of a feed carry a name."""
    return feed_channels.groupBy("source_index", "norm").agg(F.sort_array(F.collect_set("id")).alias("ids"), F.count_distinct("id").alias("n_ids"))


def fan_out(programmes: DataFrame, mapping: DataFrame) -> DataFrame:
    """Each kept programme once for every output id of its source: an id that two sources serve has both."""
    targets = mapping.select("source_index", F.col("source_id").alias("channel"), "output_tvg_id").distinct()
    return programmes.where("kept").join(targets, ["source_index", "channel"])


def fan_out_needed(programmes: DataFrame, second: DataFrame, counts: DataFrame) -> DataFrame:
    """Second pass: only output ids without a usable programme, and of their sources those up to the first that has one."""
    needy = second.join(counts.where("usable > 0"), "output_tvg_id", "left_anti")
    out = fan_out(programmes, needy)
    per = out.groupBy("output_tvg_id", "source_index").agg(F.count_if("usable").alias("u"))
    w = Window.partitionBy("output_tvg_id").orderBy("source_index").rowsBetween(Window.unboundedPreceding, -1)
    open_ = per.withColumn("before", F.coalesce(F.sum("u").over(w), F.lit(0))).where("before = 0")
    return out.join(open_.select("output_tvg_id", "source_index"), ["output_tvg_id", "source_index"], "left_semi")


def programme_counts(programmes: DataFrame) -> DataFrame:
    return programmes.groupBy("output_tvg_id").agg(F.count("*").alias("programmes"), F.count_if("usable").alias("usable"))


def channel_elements(mapping: DataFrame, feed_channels: DataFrame) -> DataFrame:
    """One channel for each output id, of the first mapping row, with the playlist's name before the feed's names."""
    names = feed_channels.select("source_index", F.col("id").alias("source_id"), "display_names")
    first = first_wins(mapping, ["output_tvg_id"], "channel_index")
    out = first.join(names, ["source_index", "source_id"], "left")
    own = F.coalesce("display_names", F.array().cast("array<string>"))
    return out.select("output_tvg_id", F.array_distinct(F.array_prepend(own, F.col("playlist_name"))).alias("display_names"))


def coverage(channels: DataFrame, mapping: DataFrame) -> DataFrame:
    """Of each group: channels, matched by the first source, matched, added, percent."""
    m = mapping.select("channel_index", "source_index")
    joined = channels.select("channel_index", "grp").join(m, "channel_index", "left")
    c = joined.groupBy("grp").agg(F.count("*").alias("total"), F.count_if(F.col("source_index") == 0).alias("baseline"), F.count("source_index").alias("matched"))
    return c.withColumns({"added": F.col("matched") - F.col("baseline"), "pct": F.round(100 * F.col("matched") / F.col("total"), 1)})


def rollup_groups(covered: DataFrame, groups: list[str]) -> DataFrame:
    return covered.where(F.col("grp").isin(groups)).agg(*[F.sum(c).alias(c) for c in ("total", "baseline", "matched", "added")])


def source_report(mapping: DataFrame) -> DataFrame:
    """Of each source: matched (both passes), recovered by families, average confidence."""
    return mapping.groupBy("source").agg(F.count("*").alias("matched"), F.count_if(F.col("pass") == 2).alias("family_recovered"), F.round(F.avg("confidence"), 1).alias("confidence"))


def without_quarantined(mapping: DataFrame, flagged: DataFrame) -> DataFrame:
    """Mapping rows whose (name, source, id) isn't flagged: rows of one key go together. The guide keeps its programmes."""
    return mapping.join(flagged.select("playlist_name", "source", "source_id").distinct(), ["playlist_name", "source", "source_id"], "left_anti")


def validated(mapping: DataFrame, counts: DataFrame) -> DataFrame:
    """Mapping with programmes, usable and whether both are above 0."""
    n = lambda c: F.coalesce(c, F.lit(0))
    return mapping.join(counts, "output_tvg_id", "left").withColumns({"programmes": n("programmes"), "usable": n("usable")}).withColumn("valid", (F.col("programmes") > 0) & (F.col("usable") > 0))


class GateClosed(Exception):
    """A safety gate stops the run before anything is written."""


def gate_drop(previous: int, current: int, least: int, share: float, what: str) -> None:
    """Stops where a count that was at least `least` fell under a share of it; and where there is nothing at all."""
    if current == 0:
        raise GateClosed(f"no {what}")
    if previous >= least and current < share * previous:
        raise GateClosed(f"{what}: {current} after {previous}")


def gate_header(df: DataFrame, columns: list[str]) -> None:
    if df.columns[: len(columns)] != columns:
        raise GateClosed(f"columns {df.columns[: len(columns)]}, not {columns}")


def fresh_or_previous(new: DataFrame, previous: DataFrame, least: int) -> DataFrame:
    """A rebuilt dataset, or the one before where the new one is too small."""
    return new if len(new.select(F.lit(1)).take(least)) == least else previous


def top_coverage(covered: DataFrame, n: int = 20) -> DataFrame:
    return covered.orderBy(F.desc("added"), "grp").limit(n)


def synthetic_schedule(channels: DataFrame, now: Column, blocks: int = 49, hours: int = 4) -> DataFrame:
    """A placeholder id and four-hour blocks from the block before now's hour. Audits quarantine it."""
    start = F.date_trunc("hour", now).cast("timestamp_ntz") - F.make_dt_interval(hours=F.lit(hours))
    ident = F.concat(F.lit("synthetic."), F.substr(F.sha1("name"), F.lit(1), F.lit(12)))
    out = channels.select("name", ident.alias("id"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    at = start + F.make_dt_interval(hours=F.col("block") * hours)
    return out.select("name", "id", "block", at.alias("start_at"), (at + F.make_dt_interval(hours=F.lit(hours))).alias("stop_at"))


def next_programmes(programmes: DataFrame, now: Column, n: int = 8, ties: list[str] = ()) -> DataFrame:
    """The n programmes of each channel that start after now, with their place; equal starts stand in the order of `ties`, and in no fixed one without."""
    w = Window.partitionBy("channel").orderBy("start_at", *ties)
    return programmes.where(F.col("start_at") > now).withColumn("place", F.row_number().over(w)).where(F.col("place") <= n)


def current_programme(programmes: DataFrame, now: Column, ties: list[str] = ()) -> DataFrame:
    """Of each channel the programme on air: the latest start, if several are, and of equal starts the last in the order of `ties`."""
    on_air = programmes.where((F.col("start_at") <= now) & (F.col("stop_at").isNull() | (F.col("stop_at") > now)))
    rest = [c for c in programmes.columns if c != "channel"]
    return on_air.groupBy("channel").agg(F.max_by(F.struct(*rest), F.struct("start_at", *ties)).alias("p")).select("channel", "p.*")
