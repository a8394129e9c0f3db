"""Audits: mapping accuracy, delivery, snapshots, watchlists, families of unmatched channels, run history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.regions import compatible, id_region, is_sensitive
from tidemark.functions.text import filled, is_enabled
from tidemark.operators.common import last_wins
from tidemark.operators.guide import current_programme, next_programmes

# Name families that are looked into as one, in order.
FAMILIES = {
    "DITV": r"^DITV(?:\s|$)", "VeleS": r"^VeleS(?:\s|$)", "Magic": r"^Magic(?:\s|$)", "KLI": r"^(?:KLI|KLI\s*MEDIA)(?:\s|$)",
    "Play-X": r"^(?:Play[- ]?X)(?:\s|$)", "BCU": r"^(?:BCU|BCU\s*Media)(?:\s|$)", "Joker": r"^(?:Joker(?::|\s|$)|jk[_-])",
    "Clarity": r"^Clarity(?:4K)?(?:\s|$)", "CPS": r"^CPS(?:\s|$)", "NEXT": r"^NEXT(?:\s|$)", "CineMan": r"^CineMan(?:\s|$)",
    "MiniMax/MM": r"^(?:MiniMax|MM)(?:\s|$)", "Fresh": r"^Fresh(?:\s|$)", "BOX": r"^BOX(?:\s|$)", "Velilla": r"^Velilla(?:\s|$)", "KBC": r"^KBC(?:\s|$)",
}
GENERIC_FIRST = ("hd", "fhd", "uhd", "4k", "tv", "channel", "канал", "кино", "movie", "cinema", "the", "русский", "россия", "украина", "ua", "ru", "us", "uk")
SYNTHETIC = "synthetic schedule is not a verified real broadcast schedule"
INCOMPATIBLE = "regional-sensitive brand matched from an incompatible country feed"
ALIAS, STRONG, OPEN = "researched exact alias", "strong exact match; no country conflict detected", "mapping has not yet been cross-checked against an independent schedule"


def overrides_of(rows: DataFrame) -> DataFrame:
    """Enabled overrides by (name, id); a blank id also stands for any id. Later rows win."""
    on = rows.where(is_enabled(F.col("enabled")) & (filled(F.col("playlist_name")) != ""))
    keys = F.when(filled(F.col("source_id")) == "", F.array(F.lit(""), F.lit("*"))).otherwise(F.array(filled(F.col("source_id"))))
    out = on.select("ord", filled(F.col("playlist_name")).alias("playlist_name"), F.explode(keys).alias("source_id"), F.lower(filled(F.col("status"))).alias("status"), filled(F.col("reason")).alias("reason"), filled(F.col("evidence_url")).alias("evidence_url"))
    return last_wins(out, ["playlist_name", "source_id"], "ord")


def assess(mapping: DataFrame, feeds: DataFrame, overrides: DataFrame) -> DataFrame:
    """mapping with accuracy_status, accuracy_reason, evidence_url, quarantine: the first rule that speaks."""
    o = overrides.select("playlist_name", "source_id", F.struct("status", "reason", "evidence_url").alias("o"))
    any_id = o.where("source_id = '*'").select("playlist_name", F.col("o").alias("o_any"))
    f = last_wins(feeds.select("name", "source_index", "regions"), ["name"], "source_index").select(F.col("name").alias("source"), F.col("regions").alias("feed_regions"))
    df = mapping.join(o.where("source_id != '*'"), ["playlist_name", "source_id"], "left").join(any_id, "playlist_name", "left").join(f, "source", "left")
    own = F.coalesce("o", "o_any")
    region, method = F.upper(filled(F.col("region"))), filled(F.col("method"))
    ident = F.when(id_region(F.col("source_id")) != "", id_region(F.col("source_id"))).otherwise(id_region(F.col("output_tvg_id")))
    conflict = (region != "") & (ident != "") & ~F.array_contains(F.array_append(F.split(region, "/"), region), ident)
    foreign = (region != "") & is_sensitive(F.col("playlist_name")) & (F.size(F.coalesce("feed_regions", F.array().cast("array<string>"))) > 0) & ~compatible(region, F.col("feed_regions"))
    say = lambda status, reason: F.struct(F.lit(status).alias("status"), (reason if isinstance(reason, Column) else F.lit(reason)).alias("reason"), F.lit("").alias("evidence_url"))
    verdict = (
        F.when(own.isNotNull(), F.struct(F.when(own["status"] == "", "unverified").otherwise(own["status"]).alias("status"), own["reason"].alias("reason"), own["evidence_url"].alias("evidence_url")))
        .when(F.startswith(method, F.lit("synthetic")) | F.endswith(filled(F.col("source")), F.lit("local-fallback")), say("wrong", SYNTHETIC))
        .when(conflict, say("wrong", F.concat(F.lit("explicit XMLTV country "), ident, F.lit(" conflicts with provider region "), region)))
        .when(foreign, say("wrong", INCOMPATIBLE))
        .when(method == "alias", say("verified", ALIAS))
        .when(method.isin("id", "name-region") & (F.col("confidence") >= 96), say("probable", STRONG))
        .otherwise(say("unverified", OPEN))
    )
    df = df.withColumn("v", verdict).drop("o", "o_any", "feed_regions")
    return df.select("*", F.col("v.status").alias("accuracy_status"), F.col("v.reason").alias("accuracy_reason"), F.col("v.evidence_url").alias("evidence_url"), (F.col("v.status") == "wrong").alias("quarantine")).drop("v")


def snapshot_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """key, change (added, removed, renamed, url, group), before, after. Key: tvg_id, else name; later rows win. Columns: ord, name, tvg_id, grp, url."""
    keyed = lambda df: last_wins(df.withColumn("key", F.when(filled(F.col("tvg_id")) != "", F.col("tvg_id")).otherwise(F.col("name"))).select("key", "ord", "name", "grp", "url"), ["key"], "ord")
    a, b = keyed(old).select("key", F.struct("name", "grp", "url").alias("a")), keyed(new).select("key", F.struct("name", "grp", "url").alias("b"))
    both = a.join(b, "key", "full_outer")
    change = lambda kind, when, x, y: F.when(when, F.struct(F.lit(kind).alias("change"), x.alias("before"), y.alias("after")))
    differs = lambda c: F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col(f"a.{c}") != F.col(f"b.{c}"))
    none = F.lit(None).cast("string")
    found = F.array_compact(F.array(
        change("added", F.col("a").isNull(), none, F.col("b.name")), change("removed", F.col("b").isNull(), F.col("a.name"), none),
        change("renamed", differs("name"), F.col("a.name"), F.col("b.name")), change("url", differs("url"), F.col("a.url"), F.col("b.url")), change("group", differs("grp"), F.col("a.grp"), F.col("b.grp")),
    ))
    return both.select("key", F.explode(found).alias("x")).select("key", "x.*")


def delivery_audit(delivered: DataFrame, expected: DataFrame, validated: DataFrame, protected_groups: list[str]) -> DataFrame:
    """Every delivered channel and every expected one that is missing, with its issues (`ok` for none).

    delivered: ord, name, tvg_id, tvg_name, grp. expected: ord, playlist_name, output_tvg_id (blank: none). validated:
    output_tvg_id of the channels whose guide was seen to have programmes. A repeated name is counted, not an issue.
    """
    good = validated.where(filled(F.col("output_tvg_id")) != "").select(F.col("output_tvg_id").alias("v_id")).distinct()
    e = last_wins(expected, ["playlist_name"], "ord").select(F.col("playlist_name").alias("e_name"), filled(F.col("output_tvg_id")).alias("expected_id"))
    e = e.join(good, F.col("expected_id") == F.col("v_id"), "left").select("e_name", "expected_id", F.col("v_id").isNotNull().alias("validated"))
    names = delivered.groupBy("name").agg(F.count("*").alias("copies"))
    d = delivered.join(names, "name").join(e, F.col("name") == F.col("e_name"), "left")
    actual, wanted = filled(F.col("tvg_id")), filled(F.col("expected_id"))
    sure = F.coalesce("validated", F.lit(False))
    issue = lambda cond, text: F.when(cond, F.lit(text))
    issues = F.array_compact(F.array(
        issue((wanted != "") & (actual != wanted), "wrong_tvg_id"), issue((wanted != "") & ~sure, "no_validated_programme"),
        issue((wanted == "") & F.col("grp").isin(protected_groups) & ((actual != "") | (filled(F.col("tvg_name")) != "")), "protected_unmatched_has_epg_hint"),
        issue((wanted == "") & F.startswith(F.lower(actual), F.lit("no_epg")), "placeholder_tvg_id_left"),
    ))
    status = lambda x: F.when(F.size(x) == 0, "ok").otherwise(F.array_join(x, ";"))
    found = d.select("name", filled(F.col("grp")).alias("grp"), wanted.alias("expected_id"), actual.alias("tvg_id"), ((wanted != "") & sure).alias("validated"), F.col("copies").cast("long").alias("copies"), status(issues).alias("issues"))
    gone = e.join(delivered.select("name").distinct(), F.col("e_name") == F.col("name"), "left_anti")
    missing = gone.select(F.col("e_name").alias("name"), F.lit("").alias("grp"), "expected_id", F.lit("").alias("tvg_id"), "validated", F.lit(0).cast("long").alias("copies"), F.lit("mapped_channel_missing_from_worker").alias("issues"))
    return found.unionByName(missing)


def issue_counts(audit: DataFrame) -> DataFrame:
    return audit.where("issues != 'ok'").select(F.explode(F.split("issues", ";")).alias("issue")).groupBy("issue").agg(F.count("*").alias("n"))


def watchlist(names: DataFrame, mapping: DataFrame, programmes: DataFrame, now: Column, n: int = 8) -> DataFrame:
    """Of each watched name: status, what is on now and the next n titles. mapping: ord, playlist_name, output_tvg_id; programmes: channel, title, start_at, stop_at[, ord, which orders equal starts]."""
    m = last_wins(mapping, ["playlist_name"], "ord").select(F.col("playlist_name").alias("name"), F.col("output_tvg_id").alias("channel"))
    own = names.select("name").distinct().join(m, "name", "left")
    ties = [c for c in ("ord",) if c in programmes.columns]
    p = programmes.join(own.select("channel").distinct(), "channel", "left_semi").select("channel", "title", "start_at", "stop_at", *ties)
    on = current_programme(p, now, ties).select("channel", F.col("title").alias("on_air"))
    later = next_programmes(p, now, n, ties).groupBy("channel").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "title"))), lambda x: x["title"]).alias("upcoming"))
    out = own.join(on, "channel", "left").join(later, "channel", "left")
    status = F.when(F.col("channel").isNull(), "not_mapped").when(F.col("on_air").isNull() & F.col("upcoming").isNull(), "no_current_or_upcoming_programme").otherwise("ok")
    return out.select("name", "channel", status.alias("status"), "on_air", F.coalesce("upcoming", F.array().cast("array<string>")).alias("upcoming"))


def channel_diagnostics(names: DataFrame, mapping: DataFrame, programmes: DataFrame, now: Column, n: int = 8) -> DataFrame:
    """Of each watched name: whether and how it is mapped, how many programmes its channel has and can be read, what is on and the next n.

    mapping: ord, playlist_name, output_tvg_id, grp, region, source, source_id, method (the last row of a name counts).
    programmes: channel, start, stop, title, desc, categories, start_at, stop_at (null where start or stop can't be read)[, ord, which orders equal starts].
    """
    fields = ["output_tvg_id", "grp", "region", "source", "source_id", "method"]
    own = names.select("name").distinct().join(last_wins(mapping, ["playlist_name"], "ord").select(F.col("playlist_name").alias("name"), *fields), "name", "left")
    p = programmes.join(own.select(F.col("output_tvg_id").alias("channel")).distinct(), "channel", "left_semi")
    shown = F.struct("start", "stop", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("desc", F.lit("")).alias("desc"), F.filter(F.coalesce("categories", F.array().cast("array<string>")), lambda c: filled(c) != "").alias("categories"))
    ties = [c for c in ("ord",) if c in programmes.columns]
    p = p.select("channel", "start_at", "stop_at", shown.alias("shown"), *ties)
    counts = p.groupBy("channel").agg(F.count(F.lit(1)).alias("programme_count"), F.count("start_at").alias("parseable_programme_count"))
    on = current_programme(p, now, ties).select("channel", F.col("shown").alias("current_programme"))
    later = next_programmes(p, now, n, ties).groupBy("channel").agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "shown"))), lambda x: x["shown"]).alias("upcoming_programmes"))  # n rows at most
    out = own.withColumn("channel", F.col("output_tvg_id")).join(counts, "channel", "left").join(on, "channel", "left").join(later, "channel", "left")
    matched = F.col("output_tvg_id").isNotNull()
    status = F.when(~matched, "not_mapped").when(F.col("current_programme").isNull() & F.col("upcoming_programmes").isNull(), "no_current_or_upcoming_programme").otherwise("ok")
    zero = lambda c: F.when(matched, F.coalesce(c, F.lit(0).cast("bigint"))).alias(c)
    return out.select("name", matched.alias("matched"), status.alias("status"), *fields, zero("programme_count"), zero("parseable_programme_count"), "current_programme", "upcoming_programmes")


def family_of(name: Column) -> Column:
    text = filled(name)
    tokens = F.regexp_extract_all(text, F.lit(r"([A-Za-zА-Яа-яЁё0-9+_-]+)"), F.lit(1))
    first = F.when(F.lower(F.get(tokens, F.lit(0))).isin(*GENERIC_FIRST) & (F.size(tokens) > 1), F.get(tokens, F.lit(1))).otherwise(F.get(tokens, F.lit(0)))
    other = F.when((F.size(tokens) == 0) | (F.length(first) <= 1) | F.rlike(first, F.lit("^[0-9]+$")), "Other").otherwise(F.concat(F.lit("Other: "), first))
    case = F.when(text == "", "(empty-name)")
    for family, rule in FAMILIES.items():
        case = case.when(F.rlike(text, F.lit(f"(?i){rule}")), family)
    return case.otherwise(other)


def family_report(unmatched: DataFrame) -> DataFrame:
    """Of each family: channels, those with dummy ids, and groups with counts (most common first, then first seen). unmatched: ord, name, grp, dummy.

    family_members has the channels themselves, a row each.
    """
    f = family_members(unmatched)
    groups = f.groupBy("family", "grp").agg(F.count("*").alias("n"), F.min("ord").alias("first"))
    listed = groups.groupBy("family").agg(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "first", "grp"))), lambda x: F.concat(x["grp"], F.lit(":"), (-x["n"]).cast("string"))).alias("groups"))
    whole = f.groupBy("family").agg(F.count("*").alias("n"), F.count_if("dummy").alias("dummy_ids"), F.min_by("name", "ord").alias("first_channel"))
    return whole.join(listed, "family").orderBy(F.desc("n"), F.lower("family"))


def family_members(unmatched: DataFrame) -> DataFrame:
    """unmatched with the family of each channel."""
    return unmatched.withColumn("family", family_of(F.col("name")))


def regional_queue(unmatched: DataFrame, regions: list[str], region_groups: list[str], topic_groups: list[str], unsafe_families: list[str]) -> DataFrame:
    """Channels to recover for some regions, with the reason, their family and whether that may go by itself after a review.

    unmatched: name, tvg_id, grp, region. By region or a region's group; or Cyrillic without Ukrainian letters in a topical
    group. Families that are made up and placeholder ids are not recovered automatically.
    """
    cyrillic = F.rlike("name", F.lit("[А-Яа-яЁё]")) & ~F.rlike("name", F.lit("[ІіЇїЄєҐґ]"))
    grp, region = filled(F.col("grp")), filled(F.col("region"))
    reason = F.when(region.isin(regions) | grp.isin(region_groups), "provider-region").when(grp.isin(topic_groups) & cyrillic, "cyrillic-topical-group")
    family = family_of(F.col("name"))
    unsafe = family.isin(unsafe_families) | F.startswith(F.lower(filled(F.col("tvg_id"))), F.lit("no_epg"))
    return unmatched.withColumns({"reason": F.when(filled(F.col("name")) != "", reason), "family": family, "automatic_recovery_allowed": F.when(unsafe, "no").otherwise("review")}).where("reason IS NOT NULL")


def history_ranking(runs: DataFrame, last: int = 180) -> DataFrame:
    """Over the last runs: of each source its runs, what it added, and runs in which it did. runs: run_id, source, added. run_id ascends with time."""
    recent = runs.select("run_id").distinct().orderBy(F.desc("run_id")).limit(last)
    out = runs.join(recent, "run_id", "left_semi").groupBy("source").agg(F.count_distinct("run_id").alias("runs"), F.sum("added").alias("total_added"), F.count_if(F.col("added") > 0).alias("successful_runs"))
    return out.orderBy(F.desc("total_added"), "source")


def rewrite_playlist(blocks: DataFrame, ids: DataFrame, groups: DataFrame, excluded: list[str], protected: list[str]) -> DataFrame:
    """Blocks of a playlist for delivery: excluded groups go, others get their group, id or lose a placeholder.

    blocks: ord, name, grp, tvg_id, extinf, url. ids: ord, playlist_name, output_tvg_id. groups: ord, name, grp (overrides).
    """
    i = last_wins(ids, ["playlist_name"], "ord").select(F.col("playlist_name").alias("i_name"), "output_tvg_id")
    g = last_wins(groups, ["name"], "ord").select(F.col("name").alias("g_name"), F.col("grp").alias("new_grp"))
    df = blocks.where(~F.col("grp").isin(excluded)).join(i, F.col("name") == F.col("i_name"), "left").join(g, F.col("name") == F.col("g_name"), "left")
    group = F.coalesce("new_grp", "grp")
    bare = F.regexp_replace("extinf", r' tvg-id="[^"]*"', "")
    nameless = F.regexp_replace(bare, r' tvg-name="[^"]*"', "")
    with_id = F.regexp_replace(bare, r"^(#EXTINF:\s*-?\d+)", F.concat(F.lit('$1 tvg-id="'), F.regexp_replace("output_tvg_id", r"([\\$])", r"\\$1"), F.lit('"')))
    action = F.when(F.col("output_tvg_id").isNotNull(), "matched").when(group.isin(protected), "stripped").when(F.rlike(F.lower("tvg_id"), F.lit("^no_epg(_|$)")), "stripped").otherwise("unchanged")
    df = df.withColumns({"action": action, "out_grp": group})
    line = F.when(F.col("action") == "matched", with_id).when(F.col("action") == "stripped", nameless).otherwise(F.col("extinf"))
    return df.select("ord", "name", "action", "out_grp", line.alias("extinf"), F.concat(F.lit("#EXTGRP:"), F.col("out_grp")).alias("extgrp"), "url")
