"""Search plans, where they end, and what budgets leave of them."""

import random

from pyspark.sql import functions as F

from tidemark.operators import lookup, running, similarity

L = F.lit


def plan(one, title, raw, year, media, hints=None):
    found = one(lookup.search_plan(L(title), L(raw), L(year), L(media), L("ru-RU"), F.array(*map(L, hints)) if hints else None))
    return [(s.query, s.year, s.language, s.media, s.label) for s in found]


def test_plan(one):
    assert plan(one, "Night Train", "Night Train", "", "movie") == [("Night Train", "", "ru-RU", "movie", "localized+year")]
    got = plan(one, "Квест. Начало", "т/с Квест. Начало, 2 с", "1999", "series", ["Quest"])
    assert got == [
        *[(q, y, lang, "series", f"{label}{end}") for q, lang, label in (("Квест. Начало", "ru-RU", "localized"), ("Kvest. Nachalo", "en-US", "translit"), ("Quest", "en-US", "alias")) for y, end in (("1999", "+year"), ("", "-no-year"))],
        *[(q, y, lang, "series", f"series-root{end}") for q, lang in (("Квест", "ru-RU"), ("Kvest", "en-US")) for y, end in (("1999", "+year"), ("", "-no-year"))],
        *[(q, y, lang, "movie", f"cross-type{end}") for q, lang in (("Квест. Начало", "ru-RU"), ("Kvest. Nachalo", "en-US")) for y, end in (("1999", "+year"), ("", "-no-year"))],
    ]


def by_hand(steps, empty):
    made, run = 0, 0
    for found, hit in steps:
        made += 1
        run = 0 if found else run + 1
        if hit or run >= empty:
            break
    return made


def test_walk(spark):
    rng = random.Random(4)
    plans = {k: [(found := rng.random() < 0.35, found and rng.random() < 0.4) for _ in range(rng.randint(1, 14))] for k in range(120)}
    df = spark.createDataFrame([(k, n, f, h) for k, steps in plans.items() for n, (f, h) in enumerate(steps)], "k int, pos int, f boolean, h boolean").repartition(3)
    for empty in (1, 2, 4):
        got = {r.k: r.n for r in lookup.walked(df, "k", "pos", F.col("f"), F.col("h"), empty).groupBy("k").agg(F.count("*").alias("n")).collect()}
        assert got == {k: by_hand(steps, empty) for k, steps in plans.items()}


CATALOGUE = "id int, pos int, title string, original_title string, year string, media string, imdb_id string"
WANTED = "query_id int, title string, raw string, year string, media string, language string, hints array<string>, priority int"


def test_search(spark):
    catalogue = spark.createDataFrame([(1, 0, "Квест", "", "", "series", "tt0000001"), (2, 1, "Night Train", "", "", "movie", ""), (3, 2, "Night Train", "", "", "series", " TT0000003"), (4, 3, "Lyutyy", "", "", "movie", "tt0000004")], CATALOGUE)
    wanted = spark.createDataFrame([
        (1, "Квест. Начало", "Квест. Начало", "", "series", "ru-RU", None, 2), (2, "Квест. 12", "Квест. 12", "", "series", "ru-RU", None, 1), (3, "Night Train", "Night Train", "", "movie", "en-US", None, 0),
        (4, "Night Train", "Night Train 2 с", "", "movie", "en-US", None, 0), (5, "Nothing at all", "x", "2001", "movie", "en-US", None, 3), (6, "Лютый", "Лютый 2. 1 с.", "", "movie", "ru-RU", None, 3),
    ], WANTED)
    got = {r.query_id: (r.status, r.attempts, r.requests, r.id, r.imdb_id, r.label) for r in lookup.search(wanted, catalogue).collect()}
    assert got == {
        1: ("unverified", 3, 4, 1, "tt0000001", "series-root+year"), 2: ("found", 3, 4, 1, "tt0000001", "series-root+year"), 3: ("no_imdb_id", 1, 2, 2, "", "localized+year"),
        4: ("found", 2, 4, 3, "tt0000003", "cross-type+year"), 5: ("not_found", 2, 2, None, None, None), 6: ("found", 1, 2, 4, "tt0000004", "localized+year"),
    }
    within = {r.query_id: r.status for r in lookup.search_within(wanted, catalogue, ["priority"], 5, 9).collect()}
    assert within == {3: "no_imdb_id", 4: "found", 2: "budget_exhausted", 1: "not_attempted", 5: "not_attempted", 6: "not_attempted"}
    assert lookup.search(wanted.limit(0), catalogue, similarity.EDITS).collect() == []


def test_running_sums(spark):
    rng = random.Random(8)
    data = [(k, rng.choice([1, 2, 2, 2]), rng.choice([None, 0, 3, 5])) for k in range(500)]
    df = spark.createDataFrame(data, "k int, grp int, cost int").repartition(5)
    got = {r.k: (r.n, r.spent) for r in running.running_sums(df, ["grp", "k"], {"n": L(1), "spent": F.col("cost")}, 7).collect()}
    n = spent = 0
    for k, _, cost in sorted(data, key=lambda r: (r[1], r[0])):
        assert got[k] == (n, spent)
        n, spent = n + 1, spent + (cost or 0)
    assert running.running_sums(df.limit(0), ["grp", "k"], {"n": L(1)}).collect() == []
    plan = running.running_sums(df, ["grp", "k"], {"n": L(1)})._jdf.queryExecution().analyzed().toString()
    assert "windowspecdefinition(_slice" in plan
