"""Looking titles up in a catalogue by a plan of searches.

A plan is a table: one row for each search of a title, in order. All searches of all titles meet the catalogue in one
similarity join; what a title's plan would have done one search after the other is then a matter of order: it ends with the
first hit that has an imdb id, or after a number of empty searches in a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import filled, normalize_name
from tidemark.functions.titles import series_root, title_variants
from tidemark.operators import similarity
from tidemark.operators.running import within_budgets
from tidemark.session import saved

#: Empty searches in a row that end a plan.
EMPTY = 4
_STEP = "array<struct<query:string,year:string,language:string,media:string,label:string>>"


def _steps(variants: Column, year: Column, media: Column, describe) -> Column:
    """Each variant with the year, then without. describe(variant): its language and label."""

    def both(v: Column) -> Column:
        language, label = describe(v)
        step = lambda y, end: F.struct(v.alias("query"), y.alias("year"), language.alias("language"), media.alias("media"), F.concat(label, F.lit(end)).alias("label"))
        return F.array(step(year, "+year"), step(F.lit(""), "-no-year"))

    return F.flatten(F.transform(variants, both)).cast(_STEP)


def search_plan(title: Column, raw: Column, year: Column, media: Column, language: Column, hints: Column | None = None) -> Column:
    """The searches for a title, each once: its variants and the curated hints; the root of a series; the other type, if the scheduled title (raw) counts parts.

    Texts without Cyrillic letters are searched in English, but for hints and the title itself.
    """
    cyrillic = lambda v: F.rlike(v, F.lit("[Ѐ-ӿ]"))
    hints = F.array().cast("array<string>") if hints is None else F.coalesce(hints, F.array().cast("array<string>"))
    year, english = filled(year), F.lit("en-US")

    def own(v: Column) -> tuple[Column, Column]:
        latin = (normalize_name(v) != normalize_name(title)) & ~cyrillic(v)
        return F.when(latin, english).otherwise(language), F.when(F.array_contains(hints, v), "alias").when(latin, "translit").otherwise("localized")

    by_letters = lambda label: lambda v: (F.when(cyrillic(v), language).otherwise(english), F.lit(label))
    none = F.array().cast(_STEP)
    variants, root = title_variants(title), series_root(title)
    other = F.when(media == "movie", "series").otherwise("movie")
    parts = F.rlike(raw, F.lit(r"(?iuU)(?<!\w)\d+\s*[сc]\.?\s*$"))
    steps = F.concat(
        _steps(F.array_union(variants, hints), year, media, own),
        F.when((media == "series") & (root != filled(title)), _steps(title_variants(root), year, F.lit("series"), by_letters("series-root"))).otherwise(none),
        F.when(parts, _steps(variants, year, other, by_letters("cross-type"))).otherwise(none),
    )
    # of searches that differ in their label only, the first
    keys = lambda s: F.transform(s, lambda x: F.struct(x["query"], x["year"], x["language"], x["media"]))
    once = lambda s: F.filter(s, lambda x, i: (x["query"] != "") & (F.array_position(keys(s), F.element_at(keys(s), i + 1)) == i + 1))
    return F.element_at(F.transform(F.array(steps), once), 1)


def walked(plan: DataFrame, key: str, pos: str, found: Column, hit: Column, empty: int = EMPTY) -> DataFrame:
    """The searches of each plan that are made: up to the first hit or the `empty`-th search in a row that finds nothing."""
    w = Window.partitionBy(key).orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = Window.partitionBy(key, "_finds").orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = plan.withColumns({"_found": found.cast("int"), "_hit": hit.cast("int")}).withColumn("_finds", F.sum("_found").over(w))
    rows = rows.withColumn("_ends", F.greatest(F.col("_hit"), (F.sum(1 - F.col("_found")).over(run) >= empty).cast("int")))
    earlier = Window.partitionBy(key).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("_over", F.coalesce(F.max("_ends").over(earlier), F.lit(0))).where("_over = 0").drop("_found", "_hit", "_finds", "_ends", "_over")


def search(wanted: DataFrame, catalogue: DataFrame, measure: similarity.Measure = similarity.BLOCKS, empty: int = EMPTY) -> DataFrame:
    """query_id, status, attempts, requests, and of the match id, imdb_id, title, label, query, similarity, confidence.

    wanted: query_id, title, raw, year, media, language, hints (array, may be null). catalogue: id, pos, title, original_title,
    year, media, imdb_id. Status: found; unverified (the match isn't safe, see safe_match); no_imdb_id (the first match of the
    plan, none had an id); not_found. requests: searches made, and one more for each that found something.
    """
    steps = wanted.select("query_id", "raw", F.posexplode(search_plan(F.col("title"), F.col("raw"), F.col("year"), F.col("media"), F.col("language"), F.col("hints"))).alias("pos", "s"))
    steps = saved(steps.select(F.struct("query_id", "pos").alias("step"), "raw", F.col("s.query").alias("title"), "s.year", "s.media", "s.label"), "plan")
    # equal searches of several titles meet the catalogue once
    asked = steps.groupBy("title", "year", "media").agg(F.min("step").alias("query_id")).withColumn("label", F.lit(""))
    met = similarity.best_candidates(asked, catalogue, measure=measure).join(asked.select("query_id", "title", "year", "media"), "query_id").drop("query_id", "confidence")
    ids = catalogue.select("id", F.lower(filled(F.col("imdb_id"))).alias("imdb_id"))
    plan = steps.join(met.join(ids, "id"), ["title", "year", "media"], "left").select("step.query_id", "step.pos", "*")
    has_id = F.coalesce(F.rlike("imdb_id", F.lit(r"^tt\d{5,12}$")), F.lit(False))
    made = walked(plan, "query_id", "pos", F.col("id").isNotNull(), has_id, empty)
    years = similarity.year_fits(F.col("year"), F.col("c_year"))
    exact = normalize_name(F.col("title")) == normalize_name(F.col("c_title"))
    sure = similarity.confidence(F.round("similarity", 3), exact, years, F.col("label"))
    match = F.struct("raw", "id", "imdb_id", F.col("c_title").alias("title"), "original_title", "label", F.col("title").alias("query"), "similarity", sure.alias("confidence"))
    first = F.min_by(match, F.when(F.col("id").isNotNull(), F.struct(~has_id, F.col("pos"))))
    one = made.groupBy("query_id").agg(F.count(F.lit(1)).alias("attempts"), (F.count(F.lit(1)) + F.count("id")).alias("requests"), first.alias("m"))
    safe = similarity.safe_match(F.col("m.raw"), F.col("m.query"), [F.col("m.title"), F.col("m.original_title")], F.col("m.label"), F.col("m.confidence"), measure)
    valid = F.rlike("m.imdb_id", F.lit(r"^tt\d{5,12}$"))
    status = F.when(F.col("m").isNull(), "not_found").when(~valid, "no_imdb_id").when(safe, "found").otherwise("unverified")
    return one.select("query_id", status.alias("status"), "attempts", "requests", "m.id", "m.imdb_id", "m.title", "m.label", "m.query", "m.similarity", "m.confidence")


def search_within(wanted: DataFrame, catalogue: DataFrame, order: list[str], titles_budget: int, requests_budget: int, measure: similarity.Measure = similarity.BLOCKS) -> DataFrame:
    """search(), as far as the budgets go: titles are taken in the order of `order` (columns of wanted); status budget_exhausted or not_attempted for the rest."""
    found = wanted.select("query_id", *order).join(search(wanted, catalogue, measure), "query_id")
    out = within_budgets(found, [*order, "query_id"], F.col("requests"), titles_budget, requests_budget)
    status = F.when(F.col("spent") == "done", F.col("status")).when(F.col("spent") == "exhausted", "budget_exhausted").otherwise("not_attempted")
    kept = lambda c: F.when(F.col("spent") == "done", F.col(c))
    return out.select("query_id", status.alias("status"), *[kept(c).alias(c) for c in ("attempts", "requests", "id", "imdb_id", "title", "label", "query", "similarity", "confidence")])
