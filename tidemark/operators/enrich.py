"""Enrichment: which titles to look up and in what order, rules by hand, merging, rendering, and the funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidemark.functions.text import filled, nonempty, normalize_name
from tidemark.functions.titles import MOVIE_PREFIX, SERIES_PREFIX, choose_description, compact_title, genre_names, rule_title
from tidemark.operators.common import first_wins, last_wins, pick


def priority(title: Column, movie_group: Column, whole_word: bool = True) -> Column:
    """0 movie group, 1 movie prefix, 2 series prefix, 3 the rest. whole_word: the prefix ends a word; else any text may follow."""
    movie, series = (MOVIE_PREFIX, SERIES_PREFIX) if whole_word else (r"(?iu)^\s*(?:х/ф|фильм|кино)", r"(?iu)^\s*(?:т/с|сериал)")
    return F.when(movie_group, 0).when(F.rlike(title, F.lit(movie)), 1).when(F.rlike(title, F.lit(series)), 2).otherwise(3)


def group_map(mapping: DataFrame, keep: str = "first") -> DataFrame:
    """output_tvg_id -> grp: enrichment keeps the first mapping row of an id, the queue the last."""
    rows = mapping.where(filled(F.col("output_tvg_id")) != "").select("output_tvg_id", "grp", "ord")
    return (first_wins if keep == "first" else last_wins)(rows, ["output_tvg_id"], "ord").select("output_tvg_id", "grp")


def queue(programmes: DataFrame) -> DataFrame:
    """Distinct title keys with the first programme by (priority, channel, order). programmes: ord, channel, priority, title, year, media, language, grp."""
    keyed = programmes.withColumn("norm", normalize_name(F.col("title"))).where(F.length("norm") >= 3)
    return first_wins(keyed.withColumn("_o", F.struct("priority", "channel", "ord")), ["norm", "year", "media", "language"], "_o").drop("_o")


def completeness(entry: Column, status: Column, fresh: Column, overview: Column, genres: Column) -> Column:
    """unknown, negative_fresh, retryable, complete or partial."""
    return F.when(entry.isNull(), "unknown").when(status != "found", F.when(fresh, "negative_fresh").otherwise("retryable")).when((filled(overview) != "") & (F.size(F.coalesce(genres, F.array().cast("array<string>"))) > 0), "complete").otherwise("partial")


def pending_rank(state: Column) -> Column:
    return F.when(state == "partial", 0).when(state == "unknown", 1).when(state == "retryable", 2).when(state == "negative_fresh", 9).when(state == "complete", 10).otherwise(5)


def queue_stats(states: DataFrame) -> DataFrame:
    """Counts by state, and what remains. states: state, overview, genres, imdb_id."""
    n = lambda *s: F.count_if(F.col("state").isin(*s))
    return states.agg(F.count("*").alias("total"), *[n(s).alias(s) for s in ("complete", "partial", "unknown", "retryable", "negative_fresh")], F.count_if("overview").alias("with_overview"), F.count_if("genres").alias("with_genres"), F.count_if(filled(F.col("imdb_id")) != "").alias("with_imdb_id"), n("unknown", "retryable", "partial").alias("remaining"))


def budgeted(pending: DataFrame, budget: int, order: list) -> DataFrame:
    """The first `budget` rows: a top-k, which each task cuts before the driver merges."""
    return pending.orderBy(*order).limit(budget)


def until_cut_off(plan: DataFrame, key: str, pos: str, hit: str, k: int) -> DataFrame:
    """Steps of a plan up to the first hit or the k-th empty step in a row."""
    w = Window.partitionBy(key).orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    islands = plan.withColumn("_island", F.sum(F.col(hit).cast("int")).over(w))
    run = F.sum(1 - F.col(hit).cast("int")).over(Window.partitionBy(key, "_island").orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cut = islands.withColumn("_run", run).withColumn("_stop", ((F.col("_run") >= k) | F.col(hit)).cast("int"))
    earlier = F.max("_stop").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return cut.withColumn("_over", F.coalesce(earlier, F.lit(0))).where("_over = 0").drop("_island", "_run", "_stop", "_over")


def apply_rules(programmes: DataFrame, rules: DataFrame) -> DataFrame:
    """programmes with the first rule whose title is equal, whose duration is reached and one of whose needles a channel name has.

    programmes: ord, title, minutes, names. rules: rule_ord, id, title_base, min_minutes, needles. Equal titles join; the
    rest is checked on what met.
    """
    p = programmes.withColumn("_base", rule_title(F.col("title")))
    r = rules.select("rule_ord", F.col("id").alias("rule_id"), F.lower(F.trim("title_base")).alias("_rule_base"), "min_minutes", "needles")
    met = p.join(r, F.col("_base") == F.col("_rule_base"))
    any_needle = F.exists("needles", lambda n: F.exists("names", lambda x: F.contains(F.lower(x), F.lower(n))))
    fits = (F.coalesce("minutes", F.lit(0)) >= F.col("min_minutes")) & ((F.size("needles") == 0) | any_needle)
    first = first_wins(met.where(fits).select("ord", "rule_ord", "rule_id"), ["ord"], "rule_ord")
    return programmes.join(first.select("ord", "rule_id"), "ord", "left")


def with_seed(entities: DataFrame, seed: DataFrame, rated: list[str], described: list[str]) -> DataFrame:
    """Entities by imdb_id: the seed's rating columns override, its descriptive columns fill blanks only."""
    s = seed.select("imdb_id", *[F.col(c).alias(f"_s_{c}") for c in (*rated, *described)])
    first = lambda a, b: F.coalesce(F.when(filled(a) != "", a), F.when(filled(b) != "", b), a)
    out = entities.join(s, "imdb_id", "left")
    new = {c: first(F.col(f"_s_{c}"), F.col(c)) for c in rated} | {c: first(F.col(c), F.col(f"_s_{c}")) for c in described}
    return out.withColumns(new).select(*entities.columns)


def report_rows(report: DataFrame) -> DataFrame:
    """The last row of each (title, year, media, status), at the place of the first. report carries ord."""
    key = ["title", "year", "media", "status"]
    rest = [c for c in report.columns if c not in (*key, "ord")]
    out = report.groupBy(*key).agg(F.min("ord").alias("ord"), *[F.max_by(c, "ord").alias(c) for c in rest])
    return out.orderBy("ord")


def written_with_counts(df: DataFrame, path: str, counters: dict[str, Column]) -> dict[str, int]:
    """Writes df as Parquet and counts the rows for which each counter holds, in the same pass over them."""
    seen = Observation()
    df.observe(seen, *[F.count_if(c).alias(name) for name, c in counters.items()]).write.mode("overwrite").parquet(path)
    return {name: seen.get[name] for name in counters}


_RATINGS = "array<struct<system:string,value:string>>"
_IMAGES = "array<struct<type:string,src:string>>"


def render(programmes: DataFrame) -> DataFrame:
    """Guide rows with found metadata written into them; applying it again changes nothing.

    programmes: title, desc, categories, date, rating (array of system, value), url (array), icon, image (array of type, src;
    may be missing), media (may be missing: movie), and found: struct<title, year, rating, imdb_id, overview, poster, backdrop,
    genre_ids, genres> (null: left as they are). Date and categories go. An imdb rating is put right in its place, or added;
    the provider's own description stays unless it is a stub; genres are numbered by the row's own type.
    """
    media = F.coalesce("media", F.lit("movie")) if "media" in programmes.columns else F.lit("movie")
    fields = programmes.schema["found"].dataType.names
    f, empty = F.col("found"), F.lit("")
    text = lambda name: filled(f[name]) if name in fields else empty
    title = compact_title(F.when(text("title") != "", text("title")).otherwise(F.col("title")), f["year"], f["rating"])
    old = F.coalesce("rating", F.array().cast(_RATINGS))
    is_imdb = lambda r: F.lower(F.trim(r["system"])) == "imdb"
    value = F.concat(text("rating"), F.lit("/10"))
    first = F.array_position(F.transform(old, is_imdb), True)
    corrected = F.transform(old, lambda r, i: F.struct(r["system"].alias("system"), F.when(i + 1 == first, value).otherwise(r["value"]).alias("value")))
    rating = F.when(text("rating") == "", old).when(first > 0, corrected).otherwise(F.array_append(old, F.struct(F.lit("IMDb").alias("system"), value.alias("value"))))
    urls = F.coalesce("url", F.array().cast("array<string>"))
    linked = F.exists(urls, lambda u: F.contains(F.lower(u), F.lit("imdb.com/title/")))
    url = F.when((text("imdb_id") != "") & ~linked, F.array_append(urls, F.concat(F.lit("https://www.imdb.com/title/"), F.lower(text("imdb_id")), F.lit("/")))).otherwise(urls)
    images = F.coalesce(F.col("image") if "image" in programmes.columns else F.lit(None).cast(_IMAGES), F.array().cast(_IMAGES))
    offered = F.array_compact(F.array(*[F.when(text(of) != "", F.struct(F.lit(kind).alias("type"), text(of).alias("src"))) for kind, of in (("poster", "poster"), ("backdrop", "backdrop"))]))
    genres = F.array_join(genre_names(f["genre_ids"], f["genres"], media), ", ")
    known = lambda new, was: F.when(f.isNotNull(), new).otherwise(was)
    was_image = F.col("image") if "image" in programmes.columns else F.lit(None).cast(_IMAGES)
    return programmes.withColumns({
        "title": known(title, F.col("title")), "rating": known(rating, F.col("rating")), "url": known(url, F.col("url")), "image": known(F.array_union(images, offered), was_image),
        "icon": known(F.when(filled(F.col("icon")) != "", F.col("icon")).otherwise(nonempty(text("poster"))), F.col("icon")), "desc": known(choose_description(F.col("desc"), text("overview")), F.col("desc")),
        "genre": known(genres, F.lit(None).cast("string")), "date": known(F.lit(None).cast("string"), F.col("date")), "categories": known(F.array().cast("array<string>"), F.col("categories")),
    })


def render_rule(programmes: DataFrame, rules: DataFrame) -> DataFrame:
    """Programmes (with rule_id) with the rule's title, date, description, rating and missing genres."""
    r = rules.select(F.col("id").alias("rule_id"), F.struct("title_base", "year", "imdb_rating", "genres", "description").alias("r"))
    out = programmes.join(r, "rule_id", "left")
    has = F.col("r").isNotNull()
    cats = F.coalesce("categories", F.array().cast("array<string>"))
    return out.withColumns({
        "title": F.when(has, compact_title(F.col("r.title_base"), F.col("r.year"), F.col("r.imdb_rating"))).otherwise(F.col("title")), "date": F.when(has, F.col("r.year")).otherwise(F.col("date")),
        "desc": F.when(has & (filled(F.col("r.description")) != ""), F.col("r.description")).otherwise(F.col("desc")), "categories": F.when(has, F.array_union(cats, F.col("r.genres"))).otherwise(cats),
    }).drop("r")


def first_pending(states: DataFrame, n: int) -> DataFrame:
    """The next n keys to look up: incomplete ones first; complete and freshly failed ones not at all."""
    rank = pending_rank(F.col("state"))
    return budgeted(states.withColumn("rank", rank).where("rank < 9"), n, ["rank", "priority", "grp", "title", "year"])
