"""Quality rules as weak supervision.

Eight rules look at a document and vote good or bad, or abstain. How often each rule's votes are right is estimated
without labels by expectation-maximisation over the counts of vote patterns of all documents (with eight rules there are
at most 3^8 patterns, however large the table). A document is kept if its posterior probability of being good is at least
one half; an abstention says nothing about it.

Built from DataFrame functions only. Words in repeated 3-word windows are found inside the row: hashes of the windows are
sorted with their positions, and equal neighbours mark repeats, so a text costs n log n and nothing is shuffled.

Cases: null or empty text: no words; base_failed. Repeated rows: a row each. Empty table: empty result. Further columns
are not carried along by `measure`; `judge` keeps those of measure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.scale import WORD, let, materialize

ROUNDS = 40
#: Where accuracies start, and how many documents' worth of belief in that stays.
START_ACCURACY, PRIOR_WEIGHT = 0.9, 10.0
#: Log-odds of good before any vote. Rules that only ever name faults can't tell it from their own accuracy, so it is given.
PRIOR_ODDS = 0.0
MIN_WORDS, MOST_REPEATED_PERCENT = 50, 50


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and what the rules look at."""
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", text.alias("text")).withColumns({"words": F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != ""), "lines": F.filter(F.split("text", "\n"), lambda x: F.rlike(x, F.lit(WORD)))})
    d = d.withColumn("grams", F.transform(F.slice("words", F.lit(1), F.greatest(F.size("words") - 2, F.lit(0))), lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2))))
    # only texts with a repeated window are sorted
    d = d.withColumn("ranked", F.when(F.size(F.array_distinct("grams")) < F.size("grams"), F.sort_array(F.transform("grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    same = lambda x, i: F.coalesce(F.get("ranked", i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get("ranked", i + 1)["h"] == x["h"], F.lit(False))
    d = d.withColumn("repeated", F.sort_array(F.transform(F.filter("ranked", same), lambda x: x["i"])))
    covered = F.aggregate(F.transform("repeated", lambda x, k: F.least(F.lit(3), F.coalesce(F.get("repeated", k + 1) - x, F.lit(3)))), F.lit(0), lambda a, x: a + x)
    long = lambda c: c.cast("long")
    return d.select(
        "doc_id",
        long(F.size("words")).alias("n_words"),
        long(F.length(F.array_join("words", ""))).alias("word_chars"),
        long(F.regexp_count("text", F.lit("[#*$%&|<>]"))).alias("n_symbols"),
        long(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        long(covered).alias("n_repeat_words"),
        long(F.size("lines")).alias("n_lines"),
        long(F.size(F.array_distinct("words"))).alias("n_distinct"),
        long(F.regexp_count("text", F.lit("[A-Z]"))).alias("n_capitals"),
        long(F.regexp_count("text", F.lit("!"))).alias("n_shouts"),
    )


def votes() -> list[Column]:
    """A vote of each rule: 1 good, 0 bad, null abstains. Most rules know one fault and say nothing else."""
    n, per_word = F.col("n_words"), lambda c: F.col(c) / F.greatest(F.col("n_words"), F.lit(1))
    length = F.col("word_chars") / F.greatest(n, F.lit(1))
    spread = per_word("n_distinct")
    bad = lambda fault: F.when(fault, 0)
    prose = (per_word("n_symbols") < 0.1) & (per_word("n_repeat_words") < 0.15) & (n >= 5 * F.col("n_lines"))
    return [
        bad(per_word("n_symbols") > 0.2),
        bad(F.col("n_dup_lines") * 10 > F.col("n_lines") * 3),
        bad(per_word("n_repeat_words") > 0.3),
        bad(F.col("n_capitals") * 2 > F.col("word_chars")),
        bad((n > 0) & ((length < 2) | (length > 14))),
        bad((n < 3 * F.col("n_lines")) & (F.col("n_lines") >= 5)),
        bad(per_word("n_shouts") > 0.3),
        F.when((n >= 20) & (n <= 2000) & (spread < 0.2), 0).when(prose, 1),
    ]


def _log_odds(pattern: Column, accuracy: Column) -> Column:
    """Log-odds of good: the prior's, and each vote's by its rule's accuracy; an abstention says nothing."""
    part = lambda v, a: F.when(v == 1, F.log(a / (1 - a))).when(v == 0, F.log((1 - a) / a)).otherwise(0.0)
    return F.lit(PRIOR_ODDS) + F.aggregate(F.zip_with(pattern, accuracy, part), F.lit(0.0), lambda s, x: s + x)


def estimate(voted: DataFrame, rounds: int = ROUNDS) -> list[float]:
    """Each rule's accuracy, from a column `votes` (array of 1, 0, -1 for an abstention)."""
    many = len(votes())
    patterns = voted.groupBy("votes").agg(F.count("*").cast("double").alias("n"))
    one = patterns.agg(F.sort_array(F.collect_list(F.struct("votes", "n"))).alias("patterns"))

    def round_of(accuracy: Column, _: Column) -> Column:
        def add(s: Column, p: Column) -> Column:
            def with_posterior(q: Column) -> Column:
                right = lambda v: p["n"] * F.when(v == 1, q).when(v == 0, 1 - q).otherwise(0.0)
                return F.zip_with(s, p["votes"], lambda r, v: F.struct((r["right"] + right(v)).alias("right"), (r["all"] + F.when(v >= 0, p["n"]).otherwise(0.0)).alias("all")))

            return let(1 / (1 + F.exp(-_log_odds(p["votes"], accuracy))), with_posterior)

        none = F.array(*[F.struct(F.lit(0.0).alias("right"), F.lit(0.0).alias("all"))] * many)
        return F.transform(F.aggregate("patterns", none, add), lambda r: (r["right"] + START_ACCURACY * PRIOR_WEIGHT) / (r["all"] + PRIOR_WEIGHT))

    begin = F.array(*[F.lit(START_ACCURACY)] * many)
    return list(one.select(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), begin, round_of).alias("x")).first()["x"])


def judge(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """What measure gives, then votes, base_failed, quality (posterior probability of good) and kept."""
    coded = F.array(*[F.coalesce(v, F.lit(-1)) for v in votes()])
    voted = materialize(measure(docs).withColumn("votes", coded), "rules-votes")
    accuracy = estimate(voted, rounds)
    literal = F.array(*[F.lit(x) for x in accuracy])
    out = voted.withColumn("quality", 1 / (1 + F.exp(-_log_odds(F.col("votes"), literal))))
    out = out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))
