"""Resolving playlist channels against prioritised feeds.

All candidates of all rules are found by equi-joins at once and ranked: source first, then the rule's strength, then the
order of names and rules. A channel is taken by its best candidate. Since what matches in one feed doesn't depend on other
channels, this is what trying feed after feed gives. A veto is a candidate without an id that wins its rank.

channels: channel_index, name, tvg_id, tvg_name, grp. feeds: source_index, name, groups, regions, require_region_for_id.
feed_names: source_index, id, norm. feed_ids: source_index, id. aliases: ord, name, source, grp, region, target_id, hard_pin.
Every candidate comes from an equi-join; a feed's scope, regions and pins are then checked on what met. Whether a side is
broadcast is left to its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.regions import compatible, family_keys, group_region, is_sensitive
from tidemark.functions.text import is_enabled, is_real_id, normalize_name
from tidemark.operators.common import first_wins, last_wins, unique_only
from tidemark.session import saved

#: Rank and confidence of each rule.
METHODS = {"alias": (1, 100), "id": (2, 99), "name-region": (3, 96), "name": (3, 90), "family-region": (4, 92)}


def prepared(channels: DataFrame) -> DataFrame:
    """Channels with region, sensitivity and whether their id is real."""
    return channels.withColumns({"region": group_region(F.col("grp")), "sensitive": is_sensitive(F.col("name")), "real_id": is_real_id(F.col("tvg_id"))})


def _open(met: DataFrame, feeds: DataFrame, aliases: DataFrame) -> DataFrame:
    """What met, with its feed's columns, where the feed's scope admits the channel's group and no pin points elsewhere."""
    f = feeds.select("source_index", F.col("name").alias("source"), "groups", "regions", "require_region_for_id")
    pins = aliases.where(is_enabled(F.col("hard_pin"), blank=False)).groupBy(F.col("name").alias("pin_name")).agg(F.collect_set("source").alias("pins"))
    met = met.join(f, "source_index").where((F.size("groups") == 0) | F.array_contains("groups", F.col("grp")))
    return met.join(pins, met["name"] == pins["pin_name"], "left").where(F.col("pins").isNull() | F.array_contains("pins", F.col("source"))).drop("pins", "pin_name", "groups")


def _candidate(df: DataFrame, method: str | None, order, target="id") -> DataFrame:
    name = F.lit(method) if method else F.col("method")
    rank = F.lit(METHODS[method][0]) if method else F.lit(METHODS["name"][0])
    confidence = F.lit(METHODS[method][1]) if method else F.when(F.col("method") == "name-region", METHODS["name-region"][1]).otherwise(METHODS["name"][1])
    return df.select("channel_index", "source_index", "source", F.col(target).alias("source_id"), name.alias("method"), confidence.alias("confidence"), rank.alias("rank"), order.cast("long").alias("ord"))


def by_alias(channels: DataFrame, feeds: DataFrame, aliases: DataFrame, feed_ids: DataFrame) -> DataFrame:
    """Aliases of the channel's name whose target a feed has; blank source, group or region in the rule is any."""
    a = aliases.select("ord", F.col("name").alias("a_name"), F.col("source").alias("a_source"), F.col("grp").alias("a_grp"), F.col("region").alias("a_region"), F.col("target_id").alias("id"))
    blank_or = lambda rule, own: (F.col(rule) == "") | (F.col(rule) == F.col(own))
    met = channels.join(a, (F.col("name") == F.col("a_name")) & blank_or("a_grp", "grp") & blank_or("a_region", "region")).join(feed_ids.distinct(), "id")
    return _candidate(_open(met, feeds, aliases).where(blank_or("a_source", "source")), "alias", F.col("ord"))


def by_id(channels: DataFrame, feeds: DataFrame, aliases: DataFrame, feed_ids: DataFrame) -> DataFrame:
    """An equal id; without an id (a veto) where the feed asks for a region that the channel doesn't have."""
    met = channels.where("real_id").join(feed_ids.distinct(), F.col("tvg_id") == F.col("id"))
    veto = F.col("require_region_for_id") & ~compatible(F.col("region"), F.col("regions"))
    return _candidate(_open(met, feeds, aliases).withColumn("id", F.when(~veto, F.col("id"))), "id", F.lit(0))


def by_name(channels: DataFrame, feeds: DataFrame, aliases: DataFrame, feed_names: DataFrame) -> DataFrame:
    """The name, then the provider's name, where one id of the feed has it; sensitive brands need a compatible feed."""
    single = unique_only(feed_names, ["source_index", "norm"], "id")
    names = F.array(normalize_name(F.col("name")), normalize_name(F.col("tvg_name")))
    tried = channels.select("*", F.posexplode(names).alias("ord", "norm")).where("norm != ''").join(single, "norm")
    fits = compatible(F.col("region"), F.col("regions"))
    return _candidate(_open(tried, feeds, aliases).where(~F.col("sensitive") | fits).withColumn("method", F.when(F.col("sensitive"), "name-region").otherwise("name")), None, F.col("ord"))


def by_family(channels: DataFrame, feeds: DataFrame, aliases: DataFrame, feed_names: DataFrame) -> DataFrame:
    """Sensitive channels in compatible feeds by their further family keys."""
    single = unique_only(feed_names, ["source_index", "norm"], "id")
    keyed = channels.where("sensitive").withColumn("_keys", family_keys(F.col("name"), F.col("region")))
    tried = keyed.select("*", F.posexplode(F.slice("_keys", F.lit(2), F.greatest(F.size("_keys"), F.lit(1)))).alias("ord", "norm")).drop("_keys").join(single, "norm")
    return _candidate(_open(tried, feeds, aliases).where(compatible(F.col("region"), F.col("regions"))), "family-region", F.col("ord"))


def ranked(candidates: DataFrame) -> DataFrame:
    """One candidate for each channel. In a feed the strongest rule speaks, so a veto ends it for that feed only."""
    in_feed = first_wins(candidates.withColumn("_o", F.struct("rank", "ord", F.coalesce("source_id", F.lit("")))), ["channel_index", "source_index"], "_o").where(F.col("source_id").isNotNull())
    return first_wins(in_feed, ["channel_index"], "source_index").drop("rank", "ord", "_o")


def resolve(channels: DataFrame, feeds: DataFrame, feed_ids: DataFrame, feed_names: DataFrame, aliases: DataFrame) -> DataFrame:
    """Both passes: channel_index, source_index, source, source_id, method, confidence, pass. Families only for what is left over."""
    c = saved(prepared(channels), "channels")
    first = ranked(by_alias(c, feeds, aliases, feed_ids).unionByName(by_id(c, feeds, aliases, feed_ids)).unionByName(by_name(c, feeds, aliases, feed_names))).withColumn("pass", F.lit(1))
    # both passes use it
    first = saved(first, "first-pass")
    left = c.join(first, "channel_index", "left_anti")
    second = ranked(by_family(left, feeds, aliases, feed_names)).withColumn("pass", F.lit(2))
    return first.unionByName(second)


def unresolved(channels: DataFrame, mapping: DataFrame) -> DataFrame:
    return channels.join(mapping, "channel_index", "left_anti")


def mapping_rows(channels: DataFrame, resolved: DataFrame, id_fixes: DataFrame) -> DataFrame:
    """The mapping's ten columns. The output id is the fix for the name, else a real id of the playlist, else the feed's id."""
    fixes = last_wins(id_fixes.where(is_enabled(F.col("enabled"))), ["playlist_name"], "ord").select(F.col("playlist_name").alias("fix_name"), "new_tvg_id")
    df = prepared(channels).join(resolved, "channel_index")
    df = df.join(fixes, df["name"] == fixes["fix_name"], "left")
    out = F.coalesce(F.when(F.col("new_tvg_id") != "", F.col("new_tvg_id")), F.when(F.col("real_id"), F.col("tvg_id")), F.col("source_id"))
    return df.select("channel_index", F.col("name").alias("playlist_name"), F.col("tvg_id").alias("playlist_tvg_id"), out.alias("output_tvg_id"), "grp", "region", "source", "source_index", "source_id", "method", "confidence", "pass")
