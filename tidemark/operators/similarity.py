"""Similarity joins of titles, scores, and the guards against false matches.

Only pairs that can reach their threshold are scored, and no pair that can is left out. Two texts of m and n characters whose
similarity is t or more have at least t (m + n) / 2 characters in common, each counted as often as both have it; that holds
for the ratio of matching blocks and for the edit distance alike. So (1) their lengths are near, (2) of the rarest characters
of both, as many as could be missing and one more, one is common (the join goes by these, rarest first), and (3) the common
characters are counted. Equal texts are scored once for all titles that have them.

The ratio of matching blocks has no built-in form and runs on Arrow batches of what is left.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import filled, normalize_name, transliterate
from tidemark.functions.titles import PREFIX, search_title
from tidemark.operators.common import pick

#: The lowest threshold of any title.
LEAST = 0.82


def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)])


@dataclass(frozen=True)
class Measure:
    """forms: the texts of a title that are compared, each with the other title's of the same place. score: of two different texts."""

    forms: Callable[[Column], list[Column]]
    score: Callable[[Column, Column], Column]


#: Matching blocks of the name keys, or of their transliterations if that is more.
BLOCKS = Measure(lambda c: [normalize_name(c), normalize_name(transliterate(c))], lambda a, b: F.pandas_udf(_ratio, "double")(a, b))
#: 1 less the share of the longer text that has to be edited.
EDITS = Measure(lambda c: [filled(c)], lambda a, b: 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b)))


def similarity(left: Column, right: Column, measure: Measure = BLOCKS) -> Column:
    """1 for equal first forms; else the best score of the forms; 0 if a first form is empty."""
    pairs = list(zip(measure.forms(left), measure.forms(right), strict=True))
    (a, b), scores = pairs[0], [F.when(x == y, 1.0).otherwise(measure.score(x, y)) for x, y in pairs]
    return F.when((a == "") | (b == ""), 0.0).when(a == b, 1.0).otherwise(F.greatest(*scores) if len(scores) > 1 else scores[0])


def _characters(text: Column) -> Column:
    """The characters of a text as a set: a character's second occurrence is another member than its first."""
    each = F.filter(F.split(text, ""), lambda c: c != "")
    return F.array_distinct(F.transform(each, lambda c, k: F.concat(c, F.size(F.filter(F.slice(each, 1, k + 1), lambda x: x == c)).cast("string"))))


def _missable(n: Column, t: Column) -> Column:
    """How many of n characters may be missing in any text that is similar by t."""
    shortest = F.ceil(n * t / (2 - t) - 1e-9)
    return n - F.ceil(t * (n + shortest) / 2 - 1e-9)


def similar_texts(left: DataFrame, right: DataFrame, measure: Measure) -> DataFrame:
    """grp, a, b, similarity: the pairs of texts of a group whose similarity is at least the left one's threshold.

    left: grp, a, least (a text once). right: grp, b.
    """
    lefts = left.where("a != ''").select("grp", "a", "least", _characters(F.col("a")).alias("a_chars"))
    rights = right.where("b != ''").select("grp", "b").distinct().withColumn("b_chars", _characters(F.col("b")))
    # one row for each character of the texts, with how common it is: as many rows as characters and repeats exist
    seen = rights.select(F.explode("b_chars").alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("seen"))

    def rarest(df: DataFrame, text: str, chars: str, t: Column) -> DataFrame:
        rows = df.select("grp", text, t.alias("t"), F.size(chars).alias("n"), F.explode(chars).alias("c")).join(seen, "c", "left")
        each = rows.groupBy("grp", text, "t", "n").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "c"))).alias("by"))
        first = F.slice("by", 1, (_missable(F.col("n"), F.col("t")) + 1).cast("int"))
        return each.select("grp", text, "n", F.explode(F.transform(first, lambda x: x["c"])).alias("c"))

    a = rarest(lefts, "a", "a_chars", F.col("least")).withColumnRenamed("n", "m")
    b = rarest(rights, "b", "b_chars", F.lit(LEAST))
    near = F.least("m", "n") * 2 >= LEAST * (F.col("m") + F.col("n")) - 1e-9
    met = a.join(b, ["grp", "c"]).where(near).select("grp", "a", "b").distinct()
    met = met.join(lefts, ["grp", "a"]).join(rights, ["grp", "b"])
    common = F.size(F.array_intersect("a_chars", "b_chars"))
    can = met.where(common >= F.col("least") * (F.size("a_chars") + F.size("b_chars")) / 2 - 1e-9).select("grp", "a", "b", "least")
    scored = can.withColumn("similarity", F.when(F.col("a") == F.col("b"), F.lit(1.0)).otherwise(measure.score(F.col("a"), F.col("b"))))
    return scored.where(F.col("similarity") >= F.col("least")).drop("least")


def threshold(title: Column, year: Column) -> Column:
    key = normalize_name(title)
    return F.when((filled(year) == "") & (F.size(F.split(key, " ")) <= 1), 0.92).when((filled(year) == "") & (F.length(key) <= 5), 0.90).otherwise(0.82)


def year_fits(a: Column, b: Column) -> Column:
    return F.coalesce((filled(a) != "") & (filled(b) != "") & (F.abs(a.try_cast("int") - b.try_cast("int")) <= 1), F.lit(False))


def confidence(sim: Column, exact: Column, years: Column, label: Column) -> Column:
    """84 to 100 by bands, less 3 for the other type and 1 each for transliteration and alias."""
    band = F.when(exact & years, 100).when(exact, 98).when((sim >= 0.95) & years, 97).when(sim >= 0.95, 95).when(sim >= 0.90, 92).when(sim >= 0.84, 88).otherwise(84)
    less = lambda word, n: F.when(F.contains(label, F.lit(word)), n).otherwise(0)
    return F.greatest(F.lit(0), F.least(F.lit(100), band - less("cross-type", 3) - less("translit", 1) - less("alias", 1)))


def _forms(titles: dict[str, Column], measure: Measure) -> Column:
    """array<struct<k, text>> of all titles' forms; of a title whose first form is empty none."""
    each = [(k, form, forms[0]) for forms in (measure.forms(t) for t in titles.values()) for k, form in enumerate(forms)]
    return F.array_compact(F.array_distinct(F.array(*[F.when((first != "") & (form != ""), F.struct(F.lit(k).alias("k"), form.alias("text"))) for k, form, first in each])))


def best_candidates(queries: DataFrame, catalogue: DataFrame, multi: bool = False, measure: Measure = BLOCKS) -> DataFrame:
    """The best candidate of each query at or over its threshold, of all the catalogue.

    queries: query_id, title, year, media, label. catalogue: id, pos, title, original_title, year, media. Ties go to the first
    pos, then id. multi: candidates of the other type count too, the own type has a bonus, and the threshold is 0.84 at least.
    """
    least = F.greatest(threshold(F.col("title"), F.col("year")), F.lit(0.84)) if multi else threshold(F.col("title"), F.col("year"))
    media = F.lit("") if multi else F.coalesce("media", F.lit(""))
    q = queries.withColumn("least", least)
    c = catalogue.select("id", "pos", F.col("title").alias("c_title"), "original_title", F.col("year").alias("c_year"), F.col("media").alias("c_media"), media.alias("_media"))
    q_forms = q.select("query_id", "least", media.alias("_media"), F.explode(_forms({"title": F.col("title")}, measure)).alias("f")).select("query_id", "least", F.struct("_media", "f.k").alias("grp"), F.col("f.text").alias("a"))
    c_forms = c.select("id", "pos", "_media", F.explode(_forms({"title": F.col("c_title"), "original": F.col("original_title")}, measure)).alias("f")).select("id", "pos", F.struct("_media", "f.k").alias("grp"), F.col("f.text").alias("b"))
    texts = similar_texts(q_forms.groupBy("grp", "a").agg(F.min("least").alias("least")), c_forms, measure)
    met = q_forms.join(texts, ["grp", "a"]).join(c_forms, ["grp", "b"]).where(F.col("similarity") >= F.col("least")).groupBy("query_id", "id", "pos").agg(F.max("similarity").alias("similarity"))
    met = met.join(q, "query_id").join(c.drop("_media"), ["id", "pos"])
    years = year_fits(F.col("year"), F.col("c_year"))
    met = met.where((filled(F.col("year")) == "") | (filled(F.col("c_year")) == "") | years)
    bonus = F.when(years, 0.08).otherwise(0.0) + (F.when(F.col("media") == F.col("c_media"), 0.03).otherwise(0.0) if multi else F.lit(0.0))
    best = pick(met.withColumn("score", F.col("similarity") + bonus), ["query_id"], [F.desc("score"), "pos", "id"])
    exact = normalize_name(F.col("title")) == normalize_name(F.col("c_title"))
    return best.select("query_id", "id", "c_title", "original_title", "c_year", "similarity", "score", confidence(F.col("similarity"), exact, years, F.col("label")).alias("confidence"))


def best_by_id(results: DataFrame) -> DataFrame:
    """Of the rows found for an id: with an overview, more genres, more popular; movies before series. results: key, id, media, overview, genre_ids, popularity."""
    order = F.struct((filled(F.col("overview")) != "").alias("o"), F.size("genre_ids").alias("g"), "popularity", (F.col("media") == "movie").alias("m"), (-F.col("id")).alias("i"))
    return results.groupBy("key").agg(F.max_by(F.struct("id", "media", "overview"), order).alias("x")).select("key", "x.*")


def numbers(c: Column) -> Column:
    """Numbers of one to four digits that tell works apart: years from 1900 to 2099 don't count."""
    found = F.transform(F.regexp_extract_all(filled(c), F.lit(r"(?<!\d)(\d{1,4})(?!\d)"), F.lit(1)), lambda x: x.cast("int"))
    return F.filter(found, lambda x: ~x.between(1900, 2099))


def own_numbers(raw: Column) -> Column:
    """The numbers of a scheduled title without its prefix, age mark and the episodes at its end."""
    x = F.trim(F.regexp_replace(F.regexp_replace(filled(raw), PREFIX, ""), r"\s*[\[(]\s*\d{1,2}\+\s*[\])]\s*", " "))
    for ending in (r"\d+\s*(?:и|і|&|and|[-–—])\s*\d+\s*[сc]\.?\s*$", r"\d+\s*[сc]\.?\s*$"):
        x = F.regexp_replace(x, rf"(?iu)[,.;:]?\s*{ending}", "")
    return numbers(F.regexp_replace(x, r"(?iu)\s+(?:серия|сер\.|эпизод|episode)\s*\d+\b.*$", ""))


#: Fixed value: a root that stands for its whole family, whatever follows.
FAMILY_ROOT = "наш спецназ"


def safe_match(raw: Column, query: Column, names: list[Column], label: Column, conf: Column, measure: Measure = BLOCKS) -> Column:
    """Whether a match by a transliterated or shortened query may stand.

    A transliteration keeps all numbers of the scheduled title, one of the found names is as good as the title's own
    transliteration (0.93), and the confidence is 96 or more. A root may stand for a title if only a season's or an episode's
    number is cut off. Other matches stand.
    """
    title = search_title(raw)
    kept = F.size(F.array_except(own_numbers(raw), numbers(query))) == 0
    near = F.greatest(*[F.coalesce(similarity(transliterate(title), n, measure), F.lit(0.0)) for n in names], F.lit(0.0))
    suffix = F.trim(F.substr(title, F.instr(title, ". ") + 2))
    whole = (F.instr(title, ". ") == 0) | F.rlike(suffix, F.lit(r"(?iu)^(?:сезон\s*)?\d+(?:\s*[сc])?\.?$"))
    family = (normalize_name(F.substring_index(title, ". ", 1)) == FAMILY_ROOT) & (suffix != "")
    return F.when(F.startswith(label, F.lit("translit")), kept & (near >= 0.93) & (F.coalesce(conf, F.lit(0)) >= 96)).when(F.startswith(label, F.lit("series-root")), whole | family).otherwise(True)


def sanitized(entries: DataFrame) -> DataFrame:
    """Cached entries (status, imdb_id, resolver, confidence, overview, genre_ids, rating, votes, ...) as they may be used again.

    A find with an imdb id has it in small letters, counts as the search's own, and loses its rating, which is kept apart. A find
    without a confidence isn't trusted: `legacy_unscored`, its id kept as legacy_imdb_id. A trusted find without genres or overview
    is marked needs_display_refresh.
    """
    found, iid = F.col("status") == "found", F.lower(filled(F.col("imdb_id")))
    valid = found & F.rlike(iid, F.lit(r"^tt\d{5,12}$"))
    unscored = found & (filled(F.col("confidence")) == "")
    lacks = (F.coalesce(F.size("genre_ids"), F.lit(0)) <= 0) | (filled(F.col("overview")) == "")
    blank = lambda c, when: F.when(when, F.lit(None)).otherwise(F.col(c))
    return entries.withColumns({
        "status": F.when(unscored, "legacy_unscored").otherwise(F.col("status")), "legacy_imdb_id": F.when(unscored, F.when(valid, iid).otherwise(filled(F.col("imdb_id")))).otherwise(""),
        "imdb_id": F.when(unscored, "").when(valid, iid).otherwise(F.col("imdb_id")), "resolver": F.when(valid | unscored, "tmdb").otherwise(F.col("resolver")),
        "rating": blank("rating", valid | unscored), "votes": blank("votes", valid | unscored), "needs_display_refresh": found & ~unscored & lacks,
    })
