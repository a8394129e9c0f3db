"""The whole jobs: build the guide, enrich it, plan a backfill, apply rules by hand.

A build saves corrected programmes, the mapping and the counts, which many results use; all else is lazy.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import filled, nonempty, normalize_name
from tidemark.functions.timeparse import convert
from tidemark.functions.titles import canonical_title, detect_language, effective_type, existing_imdb, is_fiction, is_generic, media_type, programme_year, search_title, tidy_compact_title
from tidemark.operators import audit, enrich, guide, lookup, people, resolve, similarity, store
from tidemark.operators.common import pick
from tidemark.session import saved
from tidemark.sources import datasets, xmltv


@dataclass
class Guide:
    """What a build makes."""

    mapping: DataFrame
    audited: DataFrame
    channels: DataFrame
    programmes: DataFrame
    coverage: DataFrame
    unresolved: DataFrame


def build_guide(channels: DataFrame, feeds: DataFrame, feed_channels: DataFrame, programmes: DataFrame, aliases: DataFrame, id_fixes: DataFrame, offsets: DataFrame, overrides: DataFrame, now: Column, zone: str = "UTC") -> Guide:
    """Clocks put right, feeds cut to usable ids, both passes of the resolution, fan-out, audit, quarantine, validation, coverage.

    feed_channels: source_index, id, display_names. programmes: source_index, channel, start, stop, title, ...
    """
    named = programmes.join(feeds.select("source_index", F.col("name").alias("source")), "source_index")
    ids = named.select("source", F.col("channel").alias("source_id")).distinct()
    p = saved(guide.with_windows(guide.corrected(named, guide.clock_offsets(ids, offsets)), now), "programmes")
    live = guide.usable_index(feed_channels, p)
    names = live.select("source_index", "id", F.explode("display_names").alias("n")).select("source_index", "id", normalize_name(F.col("n")).alias("norm")).where("norm != ''").distinct()
    found = resolve.resolve(channels, feeds, live.select("source_index", "id").distinct(), names, aliases)
    mapping = saved(resolve.mapping_rows(channels, found, id_fixes), "mapping")
    first = guide.fan_out(p, mapping.where("pass = 1"))
    counts = saved(guide.programme_counts(first), "counts")
    second = guide.fan_out_needed(p, mapping.where("pass = 2"), counts)
    out = first.unionByName(second)
    audited = audit.assess(mapping, feeds, overrides)
    kept = guide.without_quarantined(mapping, audited.where("quarantine"))
    valid = guide.validated(kept, guide.programme_counts(out)).where("valid")
    # quarantined rows leave the mapping; what they brought stays in the guide
    times = convert(F.col("start"), zone), convert(F.col("stop"), zone)
    moved = xmltv.retimed(out, *times, F.col("output_tvg_id")) if "raw" in out.columns else out.withColumns({"channel": F.col("output_tvg_id"), "start": times[0], "stop": times[1]})
    shown = moved.drop("output_tvg_id")
    return Guide(valid, audited, guide.channel_elements(mapping, feed_channels), shown, guide.coverage(channels, valid), resolve.unresolved(channels, valid))


SNAPSHOT = "ord bigint, name string, tvg_id string, grp string, url string, run_id string"
HISTORY = "source string, matched bigint, family_recovered bigint, confidence double, run_id string"
STATUS = "channels bigint, matched bigint, unresolved bigint, programmes bigint, run_id string"
#: Gates: a count that was as high may not fall under this share of it.
CHANNELS_GATE, PROGRAMMES_GATE = (100, 0.85), (1000, 0.60)


def before_run(spark: SparkSession, path: str, schema: str, run_id: str) -> DataFrame:
    """The rows of the last run before this one; none if there is none. Run ids ascend with time."""
    try:
        runs = spark.read.schema(schema).parquet(path).where(F.col("run_id") < run_id)
    except AnalysisException:
        return spark.createDataFrame([], schema)
    last = runs.agg(F.max("run_id")).first()[0]
    return runs.where(F.col("run_id") == F.lit(last))


@dataclass
class Build:
    """What a build run publishes, besides its files."""

    guide: Guide
    status: DataFrame
    changes: DataFrame
    ranking: DataFrame


def build_run(channels: DataFrame, feeds: DataFrame, feed_channels: DataFrame, programmes: DataFrame, aliases: DataFrame, id_fixes: DataFrame, offsets: DataFrame, overrides: DataFrame, now: Column, folder: str, run_id: str, zone: str = "UTC", programmes_share: float = PROGRAMMES_GATE[1]) -> Build:
    """One build from inputs to the published guide: guide.xml.gz, and by run snapshots, history, status and mapping under `folder`.

    Stops before anything is written where the playlist is empty or collapsed, where no programme is left, or where programmes
    fell too far. The guide takes the old one's place in one move; the run's rows come after it, so a run that fails is run again.
    channels: also url. programmes: source_index, channel, start, stop, title[, desc, categories, raw].
    """
    spark = channels.sparkSession
    snapshot = saved(channels.select(F.col("channel_index").alias("ord"), "name", "tvg_id", "grp", "url"), "snapshot")
    earlier = before_run(spark, f"{folder}/snapshots", SNAPSHOT, run_id)
    n_channels = snapshot.count()
    guide.gate_drop(earlier.count(), n_channels, *CHANNELS_GATE, "channels")
    made = build_guide(channels, feeds, feed_channels, programmes, aliases, id_fixes, offsets, overrides, now, zone)
    made.programmes = saved(made.programmes, "guide-programmes")
    made.mapping = saved(made.mapping, "guide-mapping")
    n_programmes = made.programmes.count()
    last = before_run(spark, f"{folder}/status", STATUS, run_id).first()
    guide.gate_drop(last.programmes if last else 0, n_programmes, PROGRAMMES_GATE[0], programmes_share, "programmes")
    blanks = {"desc": F.lit(None).cast("string"), "categories": F.array().cast("array<string>")}
    xmltv.write_guide(made.channels, made.programmes.withColumns({c: v for c, v in blanks.items() if c not in made.programmes.columns}), f"{folder}/guide.xml.gz")
    n_matched = made.mapping.count()
    status = spark.createDataFrame([(n_channels, n_matched, n_channels - n_matched, n_programmes)], "channels bigint, matched bigint, unresolved bigint, programmes bigint")
    changes = saved(audit.snapshot_diff(earlier, snapshot), "changes")
    for name, rows in (("snapshots", snapshot), ("history", guide.source_report(made.mapping)), ("mapping", made.mapping), ("status", status)):
        datasets.append_run(rows, f"{folder}/{name}", run_id)
    ranking = audit.history_ranking(spark.read.schema(HISTORY).parquet(f"{folder}/history").select("run_id", "source", F.col("matched").alias("added")))
    return Build(made, status, changes, ranking)


def title_queries(programmes: DataFrame, groups: DataFrame, movie_groups: list[str]) -> DataFrame:
    """Programmes that may stand for a work, with their title key. programmes: ord, channel, title, lang, categories, has_episode, date. groups: output_tvg_id, grp."""
    g = groups.select(F.col("output_tvg_id").alias("channel"), "grp")
    p = programmes.join(g, "channel", "left").withColumn("grp", F.coalesce("grp", F.lit("")))
    movie = F.col("grp").isin(movie_groups)
    p = p.where(is_fiction(F.col("title"), F.col("categories"), movie) & ~is_generic(F.col("title")))
    p = p.withColumn("media", effective_type(F.col("title"), media_type(F.col("title"), F.col("categories"), F.col("has_episode"), movie))).where("media != ''")
    p = p.withColumns({"language": detect_language(F.col("title"), F.col("lang")), "year": programme_year(F.col("date"), F.col("title"), F.col("media")), "key_title": canonical_title(F.col("title"), F.col("media")), "priority": enrich.priority(F.col("title"), movie)})
    return p.where(F.col("language").isin("ru", "en") & (F.length(normalize_name(F.col("key_title"))) >= 3))


def enrich_guide(programmes: DataFrame, queries: DataFrame, aliases: DataFrame, titles: DataFrame, details: DataFrame) -> DataFrame:
    """Programmes rendered with what the store knows: distinct keys are resolved once and joined back.

    queries: title_queries' rows. details: title_id and the struct `found` that rendering takes.
    """
    key = ["key_title", "year", "media"]
    keys = queries.select(*key).distinct().withColumn("query_id", F.xxhash64(*key))
    known = store.resolve_knowledge(keys.select("query_id", F.col("key_title").alias("title"), "year", "media"), aliases, titles)
    by_key = keys.join(known, "query_id").join(details, "title_id").select(*key, "found")
    by_row = queries.select("ord", *key).join(by_key, key).select("ord", "found")
    media = queries.select("ord", "media") if "media" not in programmes.columns else None
    shown = programmes.join(by_row, "ord", "left")
    return enrich.render(shown.join(media, "ord", "left") if media is not None else shown).drop("found", *([] if media is None else ["media"]))


@dataclass
class Enrichment:
    """What an enrichment run leaves: counters, the written guide's path, and one report row for each title that was wanted."""

    counters: dict[str, int]
    path: str
    report: DataFrame


def outcomes(programmes: DataFrame, groups: DataFrame, movie_groups: list[str]) -> DataFrame:
    """Programmes of known channels with `outcome` (existing, wanted, or why not) and, where wanted, the key to look up.

    programmes: ord, channel, title, desc, lang, categories, has_episode, date, rating, url. groups: output_tvg_id, grp. The
    checks hold in this order: untitled, existing, generic, non_fiction, untyped, short, language.
    """
    p = programmes.join(groups.select(F.col("output_tvg_id").alias("channel"), F.coalesce("grp", F.lit("")).alias("grp")), "channel")
    movie, title = F.col("grp").isin(movie_groups), F.col("title")
    p = p.withColumns({"own": existing_imdb(F.col("desc"), F.col("url"), F.col("rating")), "typed": media_type(title, F.col("categories"), F.col("has_episode"), movie), "language": detect_language(title, F.col("lang")), "priority": enrich.priority(title, movie)})
    p = p.withColumn("media", effective_type(title, F.col("typed"))).withColumns({"year": programme_year(F.col("date"), title, F.col("media")), "key_title": canonical_title(title, F.col("media"))})
    outcome = (
        F.when(filled(title) == "", "untitled").when((F.col("own.rating") != "") | (F.col("own.imdb_id") != ""), "existing").when(is_generic(title), "generic").when(~is_fiction(title, F.col("categories"), movie), "non_fiction")
        .when(F.col("typed") == "", "untyped").when(F.length(normalize_name(title)) < 3, "short").when(~F.col("language").isin("ru", "en"), "language").otherwise("wanted")
    )
    collapsed = normalize_name(F.col("key_title")) != normalize_name(search_title(title))
    return p.withColumns({"outcome": outcome, "collapsed": collapsed, "reclassified": F.col("typed") != F.col("media")}).withColumn("norm", normalize_name(F.col("key_title")))


def enrichment_run(programmes: DataFrame, groups: DataFrame, movie_groups: list[str], aliases: DataFrame, titles: DataFrame, entities: DataFrame, seeds: DataFrame, catalogue: DataFrame, path: str, titles_budget: int, requests_budget: int, measure: similarity.Measure = similarity.BLOCKS) -> Enrichment:
    """A guide enriched and written, each distinct key resolved once: from the store, else by searching as far as the budgets go.

    titles: also imdb_id. entities: imdb_id, title, year, rating, votes, overview, poster, backdrop, genre_ids, genres. seeds: the
    same columns, as they came last: their ratings override, the rest fills blanks. catalogue: as lookup.search takes it.
    """
    key = ["norm", "year", "media", "language"]
    rows = saved(outcomes(programmes, groups, movie_groups), "outcomes")
    first = F.min_by(F.struct("priority", "channel", "ord", "key_title", "title"), F.struct("priority", "channel", "ord"))
    keys = rows.where("outcome = 'wanted'").groupBy(*key).agg(first.alias("x")).select(*key, F.col("x.ord").alias("query_id"), "x.priority", "x.channel", "x.key_title", F.col("x.title").alias("raw"))
    keys = saved(keys, "keys")
    asked = keys.select("query_id", F.col("key_title").alias("title"), "raw", "year", "media", F.when(F.col("language") == "ru", "ru-RU").otherwise("en-US").alias("language"), F.lit(None).cast("array<string>").alias("hints"), "priority", "channel")
    known = store.resolve_knowledge(asked.select("query_id", "title", "year", "media"), aliases, titles).join(titles.select("title_id", "imdb_id"), "title_id")
    known = saved(known.select("query_id", F.lit("knowledge").alias("origin"), F.lit("found").alias("status"), "imdb_id", "confidence"), "known")
    rest = asked.join(known.select("query_id"), "query_id", "left_anti")
    searched = lookup.search_within(rest, catalogue, ["priority", "channel"], titles_budget, requests_budget, measure)
    entries = saved(known.unionByName(searched.select("query_id", F.lit("search").alias("origin"), "status", F.when(F.col("status") == "found", F.col("imdb_id")).alias("imdb_id"), "confidence")), "entries")
    rated, described = ["rating", "votes"], ["title", "year", "overview", "poster", "backdrop"]
    full = enrich.with_seed(entities, seeds, rated, described)
    found = full.select("imdb_id", F.struct(*[c for c in full.columns]).alias("found"))
    per_key = keys.join(entries, "query_id").select(*key, "query_id", "origin", "status", F.col("imdb_id").alias("found_id"))
    of_row = rows.withColumns({c: F.when(F.col("outcome") == "wanted", F.col(c)) for c in ("norm",)}).join(per_key, key, "left")
    of_row = of_row.withColumn("imdb_id", F.coalesce("found_id", F.when(F.col("outcome") == "existing", nonempty(F.col("own.imdb_id")))))
    # what a programme has itself is shown under its own title, with its own rating if it has one
    own = F.col("outcome") == "existing"
    shown = of_row.join(found, "imdb_id", "left").withColumn("found", F.when(F.col("found").isNull() & ~(own & (F.col("own.rating") != "")), F.lit(None)).otherwise(F.struct(*[
        (F.when(own, F.col("title")).otherwise(F.col("found.title")) if c == "title" else F.when(own & (F.col("own.rating") != ""), F.col("own.rating")).otherwise(F.col("found.rating")) if c == "rating" else F.coalesce("found.year", "year") if c == "year" else F.col("imdb_id") if c == "imdb_id" else F.col(f"found.{c}")).alias(c)
        for c in full.columns
    ])))
    is_first, wanted = F.col("ord") == F.col("query_id"), F.col("outcome") == "wanted"
    done = lambda s: wanted & is_first & (F.col("origin") == "search") & (F.col("status") == s)
    counters = {
        "programmes_considered": F.lit(True), "programmes_with_existing_imdb": own, "generic_schedule_blocks_skipped": F.col("outcome") == "generic", "non_fiction_skipped": F.col("outcome") == "non_fiction",
        "not_movie_or_series": F.col("outcome") == "untyped", "title_too_short": F.col("outcome") == "short", "non_ru_en_titles_skipped": F.col("outcome") == "language", "uk_titles_skipped": (F.col("outcome") == "language") & (F.col("language") == "uk"),
        "episode_titles_collapsed": wanted & F.col("collapsed"), "multipart_movies_reclassified": wanted & F.col("reclassified"), "in_run_memo_hits": wanted & ~is_first, "knowledge_hits": wanted & is_first & (F.col("origin") == "knowledge"),
        **{f"lookup_{s}": done(s) for s in ("found", "unverified", "no_imdb_id", "not_found", "budget_exhausted", "not_attempted")},
        "programmes_enriched": F.col("has_found"), "programmes_with_rating": F.col("has_found") & (filled(F.col("found.rating")) != ""), "programmes_with_overview": F.col("has_found") & (filled(F.col("found.overview")) != ""),
    }
    out = enrich.render(shown.withColumn("has_found", F.col("found").isNotNull()))
    counted = enrich.written_with_counts(out, path, {k: F.coalesce(c, F.lit(False)) for k, c in counters.items()})
    report = enrich.report_rows(keys.join(entries, "query_id").select(F.col("query_id").alias("ord"), F.col("key_title").alias("title"), "year", "media", "status", "origin", "imdb_id", "confidence"))
    return Enrichment(counted, path, report)


def reapply(spark: SparkSession, guide_path: str, groups: DataFrame, movie_groups: list[str], aliases: DataFrame, titles: DataFrame, entities: DataFrame, seeds: DataFrame, work: str) -> Enrichment:
    """What the store knows by now, written into a guide that is published already; nothing is searched. The guide is replaced in one move."""
    elements = saved(xmltv.read_elements(spark, guide_path), "guide-elements")
    programmes = xmltv.programmes_of(elements, F.lit(0)).withColumnRenamed("nth", "ord")
    nothing = spark.createDataFrame([], "id bigint, pos bigint, title string, original_title string, year string, media string, imdb_id string")
    run = enrichment_run(programmes, groups, movie_groups, aliases, titles, entities, seeds, nothing, work, 0, 0)
    touched = xmltv.rendered(spark.read.parquet(work))
    others = programmes.join(groups.select(F.col("output_tvg_id").alias("channel")), "channel", "left_anti")
    columns = ["channel", "start", "stop", "title", "desc", "categories", "raw"]
    channels = xmltv.channels_of(elements, F.lit(0)).select(F.col("id").alias("output_tvg_id"), "display_names", "raw")
    xmltv.write_guide(channels, touched.select(*columns).unionByName(others.select(*columns)), guide_path)
    return run


def backfill_plan(queries: DataFrame, states: DataFrame, budget: int) -> DataFrame:
    """The next keys to look up. states: norm, year, media, language, state."""
    q = enrich.queue(queries.withColumn("title", F.col("key_title")).select("ord", "channel", "priority", "title", "year", "media", "language", "grp"))
    return enrich.first_pending(q.join(states, ["norm", "year", "media", "language"], "left").withColumn("state", F.coalesce("state", F.lit("unknown"))), budget)


def verified_fixes(programmes: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules by hand, then every compact title made regular."""
    out = enrich.render_rule(enrich.apply_rules(programmes, rules), rules)
    return out.withColumn("title", tidy_compact_title(F.col("title")))


def load_credits(people_stored: DataFrame, credits_stored: DataFrame, payload: DataFrame, cast: int = 8) -> tuple[DataFrame, DataFrame]:
    """People and credits after payloads of directors and the first `cast` actors of each title.

    payload: ord, title_id, tmdb_id, name, role, character, job, billing (rows without a name are left out). Credits:
    title_id, person_id, role, character, job, billing, ord.
    """
    named = payload.where(filled(F.col("name")) != "")
    actors = pick(named.where("role = 'actor'"), ["title_id"], [F.coalesce("billing", F.lit(999_999)), "ord"], cast)
    wanted = saved(named.where("role = 'director'").unionByName(actors), "credits")
    after, of = people.upsert_people(people_stored, wanted.select("ord", F.lit("credits").alias("path"), "tmdb_id", F.lit("").alias("imdb_id"), "name", F.lit("{}").alias("extra")))
    rows = wanted.join(of, "ord").select("title_id", F.col("person_id").cast("string").alias("person_key"), "role", "character", "job", "billing", "ord")
    held = credits_stored.withColumn("person_key", F.col("person_id").cast("string")).select(*rows.columns)
    merged = store.merge_credits(held, rows, "ord")
    return after, merged.withColumn("person_id", F.col("person_key").cast("bigint")).drop("person_key")


def with_credits(programmes: DataFrame, credits: DataFrame, top: int = 8) -> DataFrame:
    """Programmes (with title_id) with directors, then actors and their roles."""
    return programmes.join(store.cast_and_directors(credits, top), "title_id", "left")


def migrate_store(titles: DataFrame, legacy_titles: DataFrame, aliases: DataFrame, ordinal: str = "ord") -> tuple[DataFrame, DataFrame]:
    """Legacy rows merged into titles, and aliases linked to them."""
    merged = store.merge_nonempty(titles, legacy_titles, ["imdb_id"], ordinal)
    return merged, store.link_aliases(aliases, merged.where(filled(F.col("imdb_id")) != ""))
