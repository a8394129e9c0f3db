"""The knowledge store as tables: merges that keep what is known, alias learning, and lookups.

A merge is a union of the stored and the new rows followed by one aggregate by key, so it shuffles once and common keys are
summed in the tasks first. Every row carries an ordinal; blanks never win over a known value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import filled, nonempty, normalize_name
from tidemark.functions.titles import alias_variants
from tidemark.operators.common import first_wins, last_wins


def latest_nonempty(c: str, ordinal: str, blank: str = "") -> Column:
    """The last value of a text that isn't empty."""
    value = nonempty(F.col(c))
    return F.coalesce(F.max_by(value, F.when(value.isNotNull(), F.col(ordinal))), F.lit(blank)).alias(c)


def merge_nonempty(stored: DataFrame, incoming: DataFrame, keys: list[str], ordinal: str, overwrite: list[str] = ()) -> DataFrame:
    """One row for each key. New values replace old ones where they aren't empty; columns of `overwrite` always."""
    both = stored.unionByName(incoming)
    rest = [c for c in both.columns if c not in (*keys, ordinal)]
    return both.groupBy(*keys).agg(*[F.max_by(c, ordinal).alias(c) if c in overwrite else latest_nonempty(c, ordinal) for c in rest], F.max(ordinal).alias(ordinal))


def learn_aliases(evidence: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Learned aliases and conflicts. evidence: ord, alias, year, media, identity, confidence, verified, source.

    The first identity of (alias, year, media) stays. Evidence that agrees counts, raises confidence and verified, and the
    last agreeing source is kept; evidence that disagrees changes nothing and is listed as a conflict.
    """
    key = ["alias", "year", "media"]
    first = evidence.groupBy(*key).agg(F.min_by("identity", "ord").alias("first_identity"))
    judged = evidence.join(first, key)
    agree = judged.where("identity = first_identity").groupBy(*key).agg(F.first("first_identity").alias("identity"), F.count("*").alias("evidence_count"), F.max("confidence").alias("confidence"), F.max("verified").alias("verified"), F.max_by("source", "ord").alias("source"))
    clash = judged.where("identity != first_identity").groupBy(*key, "first_identity", "identity").agg(F.count("*").alias("n"))
    return agree, clash


def taught_aliases(found: DataFrame, least: int = 97, floor: int = 90) -> DataFrame:
    """Every way to write a surely found title as evidence: confidence less the way's penalty. found: ord, title, year, media, identity, confidence, source."""
    sure = found.where((F.col("confidence") >= least) & (F.col("identity") != ""))
    ways = sure.select("*", F.posexplode(alias_variants(F.col("title"))).alias("pos", "v"))
    confidence = F.greatest(F.lit(floor), F.col("confidence") - F.col("v.penalty"))
    return ways.select(F.struct("ord", "pos").alias("ord"), F.lower("v.text").alias("alias"), "year", "media", "identity", confidence.alias("confidence"), (confidence >= least).cast("int").alias("verified"), "source")


def resolve_knowledge(queries: DataFrame, aliases: DataFrame, titles: DataFrame) -> DataFrame:
    """query_id -> title_id, rule, confidence: the best of five equi-joins.

    1 alias of the year; 2 alias without a year; 3 derived variants, if they lead to one title; 4 canonical title and year,
    lowest id; 5 for a query without a year, the only title of that type. queries: query_id, title, year, media. aliases:
    alias (normalised), year, media, title_id, confidence. titles: title_id, norm, year, media.
    """
    q = queries.withColumn("norm", normalize_name(F.col("title")))
    a = aliases.select("alias", F.col("year").alias("a_year"), F.col("media").alias("a_media"), "title_id", "confidence")
    take = lambda df, rank, rule, confidence: df.select("query_id", "title_id", F.lit(rank).alias("rank"), F.lit(rule).alias("rule"), confidence.cast("int").alias("confidence"))
    met = q.join(a, (q["norm"] == a["alias"]) & (q["media"] == a["a_media"]))
    exact = take(met.where("a_year = year"), 1, "alias", F.col("confidence"))
    yearless = take(met.where("a_year = '' AND year != ''"), 2, "alias-yearless", F.col("confidence"))
    ways = q.select("query_id", "year", "media", F.explode(alias_variants(F.col("title"))).alias("v")).select("query_id", "year", "media", normalize_name(F.col("v.text")).alias("way"), F.col("v.penalty").alias("penalty"))
    derived = ways.join(a, (ways["way"] == a["alias"]) & (ways["media"] == a["a_media"]) & F.col("a_year").isin(F.col("year"), F.lit("")))
    derived = derived.groupBy("query_id").agg(F.min("title_id").alias("title_id"), F.max("title_id").alias("most"), F.max(F.col("confidence") - F.col("penalty")).alias("c")).where("title_id = most")
    variants = take(derived, 3, "variant", F.greatest(F.lit(94), F.least(F.lit(99), F.col("c"))))
    t = titles.select(F.col("title_id"), F.col("norm").alias("t_norm"), F.col("year").alias("t_year"), F.col("media").alias("t_media"))
    named = q.join(t, (q["norm"] == t["t_norm"]) & (q["media"] == t["t_media"]))
    canonical = take(named.where("t_year = year").groupBy("query_id").agg(F.min("title_id").alias("title_id")), 4, "canonical", F.lit(99))
    only = named.where("year = ''").groupBy("query_id").agg(F.min("title_id").alias("title_id"), F.max("title_id").alias("most")).where("title_id = most")
    every = exact.unionByName(yearless).unionByName(variants).unionByName(canonical).unionByName(take(only, 5, "unique-title", F.lit(99)))
    return first_wins(every.withColumn("_o", F.struct("rank", "title_id")), ["query_id"], "_o").drop("_o", "rank")


def with_fallbacks(queries: DataFrame, known: DataFrame, cached: DataFrame, legacy: DataFrame) -> DataFrame:
    """query_id with entry and origin: the store, else a fresh cached row, else a legacy alias at 98. Each: query_id, entry."""
    out = queries.select("query_id")
    for name, df in (("knowledge", known), ("cache", cached.where("fresh")), ("legacy", legacy)):
        out = out.join(df.select("query_id", F.col("entry").alias(name)), "query_id", "left")
    origin = F.when(F.col("knowledge").isNotNull(), "knowledge").when(F.col("cache").isNotNull(), "cache").when(F.col("legacy").isNotNull(), "legacy").otherwise("none")
    return out.select("query_id", F.coalesce("knowledge", "cache", "legacy").alias("entry"), origin.alias("origin"))


def find_identity(wanted: DataFrame, titles: DataFrame) -> DataFrame:
    """wanted with title_id: by imdb_id, else (tmdb_id, media), else (norm, year, media); the lowest id of each."""
    out = wanted
    for k, on in enumerate((["imdb_id"], ["tmdb_id", "media"], ["norm", "year", "media"])):
        usable = titles.where((filled(F.col(on[0])) != "")).groupBy(*on).agg(F.min("title_id").alias(f"_id{k}"))
        out = out.join(usable, on, "left")
    return out.withColumn("title_id", F.coalesce("_id0", "_id1", "_id2")).drop("_id0", "_id1", "_id2")


def alias_lookup(wanted: DataFrame, aliases: DataFrame) -> DataFrame:
    """wanted (alias, year, media) with the alias row of the year, else the one without a year."""
    row = F.struct(*[c for c in aliases.columns if c not in ("alias", "year", "media")])
    own = aliases.select("alias", "year", "media", row.alias("own"))
    free = aliases.where("year = ''").select("alias", "media", row.alias("free"))
    return wanted.join(own, ["alias", "year", "media"], "left").join(free, ["alias", "media"], "left").select(*wanted.columns, F.coalesce("own", "free").alias("found"))


def reference_titles(basics: DataFrame, ratings: DataFrame) -> DataFrame:
    """Basics with rating ('' for none) and votes (0 for none); the last row of an id counts. basics, ratings carry ord."""
    r = last_wins(ratings, ["tconst"], "ord").select("tconst", F.col("averageRating").alias("rating"), F.col("numVotes").alias("votes"))
    b = last_wins(basics, ["tconst"], "ord")
    return b.join(r, "tconst", "left").withColumns({"rating": F.coalesce("rating", F.lit("")), "votes": F.coalesce("votes", F.lit(0).cast("long"))})


def entity_rating(wanted: DataFrame, cached: DataFrame, ratings: DataFrame, as_of: Column, fresh_days: int = 30, blank_days: int = 7) -> DataFrame:
    """wanted (imdb_id) with rating, votes, checked_at: a fresh cached row, else the ratings table, stamped as_of."""
    c = cached.select("imdb_id", F.struct("rating", "votes", "checked_at").alias("c"))
    r = ratings.select(F.col("tconst").alias("imdb_id"), F.struct(F.col("averageRating").alias("rating"), F.col("numVotes").alias("votes"), as_of.alias("checked_at")).alias("r"))
    out = wanted.join(c, "imdb_id", "left").join(r, "imdb_id", "left")
    days = F.when(filled(F.col("c.rating")) != "", fresh_days).otherwise(blank_days)
    fresh = F.coalesce(F.col("c.checked_at") > as_of - F.make_dt_interval(days=days), F.lit(False))
    return out.withColumn("x", F.when(fresh, F.col("c")).otherwise(F.coalesce("r", "c"))).select(*wanted.columns, "x.*")


def people_keys(people: DataFrame, prefer_imdb: bool = True) -> DataFrame:
    """people with person_key: tmdb id, else imdb id (or, on the credits' path, the normalised name)."""
    tmdb = F.when(F.col("tmdb_id").isNotNull(), F.concat(F.lit("tmdb:"), F.col("tmdb_id").cast("string")))
    second = F.when(filled(F.col("imdb_id")) != "", F.concat(F.lit("imdb:"), F.col("imdb_id"))) if prefer_imdb else F.lit(None).cast("string")
    return people.withColumn("person_key", F.coalesce(tmdb, second, F.concat(F.lit("name:"), normalize_name(F.col("name")))))


def merge_credits(stored: DataFrame, incoming: DataFrame, ordinal: str, keep_order: bool = True) -> DataFrame:
    """One row for each (title, person, role, character, job); keep_order: a missing billing order doesn't erase a known one."""
    key = ["title_id", "person_key", "role", "character", "job"]
    both = stored.unionByName(incoming)
    at = F.when(F.col("billing").isNotNull(), F.col(ordinal)) if keep_order else F.col(ordinal)
    return both.groupBy(*key).agg(F.max_by("billing", at).alias("billing"), F.max(ordinal).alias(ordinal))


def cast_and_directors(credits: DataFrame, top: int = 8) -> DataFrame:
    """title_id, directors, actors (names): the first `top` actors by billing, unknown billing last. credits: ord, title_id, name, role, character, billing."""
    billing = F.coalesce("billing", F.lit(999_999))
    names = lambda role: F.transform(F.slice(F.sort_array(F.collect_list(F.when(F.col("role") == role, F.struct(billing.alias("b"), "ord", "name", "character")))), 1, top if role == "actor" else 1_000_000), lambda x: F.struct(x["name"].alias("name"), x["character"].alias("character")))
    return credits.groupBy("title_id").agg(F.transform(names("director"), lambda x: x["name"]).alias("directors"), names("actor").alias("actors"))


def credits_with_fallback(wanted: DataFrame, stored: DataFrame, payload: DataFrame) -> DataFrame:
    """Stored credits; for titles without any, those of the payload (movies and series with an id there)."""
    have = stored.join(wanted.select("title_id"), "title_id", "left_semi")
    rest = wanted.join(have.select("title_id").distinct(), "title_id", "left_anti").where(F.col("tmdb_id").isNotNull() & F.col("media").isin("movie", "series"))
    return have.unionByName(payload.join(rest.select("title_id", "tmdb_id"), "tmdb_id").select(*stored.columns))


def link_aliases(aliases: DataFrame, titles: DataFrame) -> DataFrame:
    """Aliases with the title_id of their imdb id where they had none."""
    t = titles.where("imdb_id != ''").groupBy("imdb_id").agg(F.min("title_id").alias("_id"))
    return aliases.join(t, "imdb_id", "left").withColumn("title_id", F.coalesce("title_id", "_id")).drop("_id")


def without_titles(table: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return table.join(keys, on, "left_anti")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def negative_is_fresh(status: Column, misses: Column, cached_at: Column, as_of: Column) -> Column:
    """Whether a cached answer still holds: a find always, failures for days that grow with the misses."""
    m = F.greatest(F.lit(1), F.coalesce(misses, F.lit(1)))
    days = F.when(status == "not_found", F.when(m <= 1, 2).when(m <= 3, 7).otherwise(30)).when(status == "no_imdb_id", F.when(m <= 2, 14).otherwise(30)).otherwise(3)
    return F.when(status == "found", True).otherwise(F.coalesce(cached_at > as_of - F.make_dt_interval(days=days), F.lit(False)))


def rating_needs_retry(status: Column, rating: Column, checked_at: Column, as_of: Column, days: int = 7) -> Column:
    due = F.coalesce(checked_at <= as_of - F.make_dt_interval(days=F.lit(days)), F.lit(True))
    return (status == "found") & (filled(rating) == "") & due


def statistics(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Key and value, later ones win. Columns: ord, key, value."""
    return last_wins(stored.unionByName(incoming), ["key"], "ord")


def lookup(wanted: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """wanted with the row of its key as `row` (null for none). The table has one row for each key."""
    rest = F.struct(*[c for c in table.columns if c not in keys]).alias("row")
    return wanted.join(table.select(*keys, rest), keys, "left")


def curated_hints(queries: DataFrame, aliases: DataFrame) -> DataFrame:
    """query_id, hint: curated search hints of each query title. aliases: norm, aliases."""
    q = queries.select("query_id", normalize_name(F.col("title")).alias("norm"))
    return q.join(aliases, "norm").select("query_id", F.explode("aliases").alias("hint"))


def legacy_entries(rows: DataFrame, language: str) -> DataFrame:
    """Store rows in the resolver's shape: the overview in the language if there is one, genres apart as numbers and names, and whether it must be shown anew. rows: title_id, title, overviews map, genres array<string>."""
    own = F.coalesce(nonempty(F.try_element_at("overviews", F.lit(language))), nonempty(F.element_at(F.concat(F.map_values("overviews"), F.array(F.lit(""))), 1)), F.lit(""))
    number = lambda g: F.rlike(g, F.lit(r"^\d+$"))
    return rows.select("title_id", "title", own.alias("overview"), F.transform(F.filter("genres", number), lambda g: g.cast("int")).alias("genre_ids"), F.filter("genres", lambda g: ~number(g)).alias("genre_names"), ((filled(F.col("title")) == "") | (own == "")).alias("needs_display_refresh"))


def validated_ids(mapping: DataFrame, feed_channels: DataFrame) -> DataFrame:
    """output_tvg_id, display_names of valid mapping rows' channels."""
    ids = mapping.where("valid").select("source_index", F.col("source_id").alias("id"), "output_tvg_id").distinct()
    return feed_channels.join(ids, ["source_index", "id"]).groupBy("output_tvg_id").agg(F.array_distinct(F.flatten(F.sort_array(F.collect_list("display_names")))).alias("display_names"))
