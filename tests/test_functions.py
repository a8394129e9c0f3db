import pytest
from pyspark.sql import functions as F

from tidemark.functions import regions, text, timeparse, titles

L = F.lit


def table(spark, pairs, column, **names):
    """column over the inputs of pairs; inputs may be tuples."""
    rows = [x if isinstance(x, tuple) else (x,) for x, _ in pairs]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], ["k", *[f"a{i}" for i in range(len(rows[0]))]])
    args = [F.col(f"a{i}") for i in range(len(rows[0]))]
    return [r[0] for r in df.orderBy("k").select(column(*args)).collect()]


def check(spark, pairs, column):
    assert table(spark, pairs, column) == [want for _, want in pairs]


def test_names(spark):
    check(spark, [("Magic Horror HD", "magic horror"), ("  Ёлка h.265  4K", "елка"), ("", ""), ("A--B", "a b")], text.normalize_name)
    check(spark, [("no_epg_cinema", False), ("magic-horror", True), ("  ", False), ("No EPG", False)], text.is_real_id)
    check(spark, [("off", False), ("", True), (" YES ", True)], text.is_enabled)
    check(spark, [("TT0133093", "tt0133093"), ("nm1", ""), ("tt12", "")], text.imdb_id)
    check(spark, [("1999", "1999"), ("2199", ""), ("99", "")], text.year_text)
    check(spark, [("1,234", 1234), ("", None), ("x", None)], text.votes)
    check(spark, [("Купель дьявола", "Kupel dyavola"), ("Щука", "Shchuka")], text.transliterate)


def test_null_names(one):
    null = L(None).cast("string")
    assert one(text.normalize_name(null)) == ""
    assert one(text.is_real_id(null)) is False
    assert one(titles.search_title(null)) == ""


def test_instants(spark):
    at = lambda c: timeparse.instant(c).cast("string")
    check(
        spark,
        [("20260816190000 +0000", "2026-08-16 19:00:00"), ("202608161900 -0700", "2026-08-17 02:00:00"), ("20260816240000 +0000", "2026-08-17 00:00:00"), ("20260816235960 +0000", "2026-08-17 00:00:00"), ("20261301120000 +0000", None), ("20260816", None), ("20260816 Z", "2026-08-16 00:00:00"), ("20260816190000 +2500", None)],
        at,
    )
    there = lambda c: timeparse.convert(c, "America/Los_Angeles")
    check(spark, [("20260816190000 +0000", "20260816120000 -0700"), ("20260116190000 +0000", "20260116110000 -0800"), ("20261301120000 +0000", "20261301120000 +0000")], there)
    check(spark, [(("20260821233000 -0700", 120), "20260822013000 -0700"), (("20260821233000 -0700", 0), "20260821233000 -0700"), (("x", 5), "x"), (("202608212330 Z", 60), "202608220030 +0000")], timeparse.shift)


def test_windows(spark):
    now = L("2026-08-17 19:00:00").cast("timestamp_ntz")
    hours = lambda a: now + F.make_dt_interval(mins=(a * 60).cast("int"))
    check(spark, [((-0.5, 0.5), True), ((24.0, 25.0), True), ((-24.0, -20.0), False), ((96.0, 97.0), False)], lambda a, b: timeparse.is_usable(hours(a), hours(b), now))
    today = L("2026-08-17").cast("date")
    check(spark, [("20260813000000 +0000", True), ("20260811000000 +0000", False), ("zz", False)], lambda c: timeparse.date_is_fresh(c, today, 5, 21))


def test_regions(spark):
    check(spark, [("Румыния", "RO"), ("Италия", "IT"), ("BE & NL", "BE/NL"), ("?", "")], regions.group_region)
    check(spark, [("Discovery Science HD RO", True), ("Кинодром", False)], regions.is_sensitive)
    check(spark, [(("BE/NL", ["BE"]), False), (("BE/NL", ["NL"]), False), (("BE/NL", ["be/nl"]), True), (("", ["RO"]), False)], regions.compatible)
    check(spark, [("XZoom.il", "IL"), ("SPORT.TV1.HD.pt", "PT"), ("Xsomething", ""), ("a.ru.ua", "")], regions.id_region)
    check(spark, [(("Discovery Science HD RO", "RO"), ["discovery science ro", "discovery science"]), (("Sky Romania Cinema", "RO"), ["sky romania cinema"]), (("Fox United Kingdom", "GB"), ["fox united kingdom", "fox"])], regions.family_keys)


def test_clean_titles(spark):
    check(spark, [("х/ф Люди в черном 3 (16+)", "Люди в черном 3"), ("т/с Квест. 5 с.", "Квест"), ("х/ф Фильм (2019)", "Фильм"), ("т/с Лютый 2. 1 и 2 с.", "Лютый")], titles.search_title)
    check(spark, [("т/с След (Нарциссы)", "След"), ("т/с След (Иное)", "След")], lambda c: titles.canonical_title(c, L("series")))
    check(spark, [(("х/ф Отравленная жизнь. 4 с.", "movie"), "series"), (("х/ф Фильм", "movie"), "movie")], titles.effective_type)
    check(spark, [("П'ятий елемент", "uk"), ("Жизнь", "ru"), ("The Martian", "en"), ("Ўсё", "be"), ("12", "unknown")], titles.detect_language)
    check(spark, [(("Купель дьявола", "ru-RU"), "ru"), (("П'ятий елемент", "ru-RU"), "uk"), (("12", "de"), "unknown")], titles.detect_language)
    check(spark, [("Spotlight, 5 с.", True), ("В приближении: кино", True), ("Фильм", False)], titles.is_generic)


def test_variants(spark):
    texts = lambda c: F.transform(titles.alias_variants(c), lambda x: x["text"])
    (found,) = table(spark, [("Х/ф Лютый 2 4K", None)], texts)
    assert "Лютый 2" in found and "Лютый" not in found and len({x.lower() for x in found}) == len(found)
    (found,) = table(spark, [("Лютый 2. Сезон 3", None)], titles.title_variants)
    assert "Лютый 2" in found
    (found,) = table(spark, [("Купель дьявола", None)], titles.title_variants)
    assert "kupel dyavola" in [x.lower() for x in found]


def test_compact_titles(spark):
    check(spark, [("Морозко 1965 (1965) · IMDb 6.4", "Морозко (1965) · IMDb 6.4"), ("Без оценки (1965)", "Без оценки (1965)")], titles.tidy_compact_title)
    check(spark, [(("1984 (1984) · IMDb 7.1", "1984", "7.1"), "1984 (1984) · IMDb 7.1"), (("х/ф Матрица", "1999", "8,7"), "Матрица (1999) · IMDb 8.7"), (("Вечера (1961) (1961) · IMDb 7.4", "1961", "7.4"), "Вечера (1961) · IMDb 7.4")], titles.compact_title)


@pytest.mark.parametrize("title", ["х/ф Матрица", "1984", "Ночь 1999", "A (2001) (2001) · IMDb 5.0", "", "· IMDb 7"])
def test_compact_title_is_idempotent(one, title):
    once = one(titles.compact_title(L(title), L("1999"), L("7.1")))
    assert one(titles.compact_title(L(once), L("1999"), L("7.1"))) == once


def test_types(spark):
    none = F.array().cast("array<string>")
    kind = lambda t, g: titles.media_type(t, none, L(False), g)
    check(spark, [(("т/с След", False), "series"), (("Кино дня", False), "movie"), (("д/ф Море", True), ""), (("Вечер", True), "movie"), (("Вечер", False), "")], kind)
    check(spark, [(("2001", "x", "movie"), "2001"), (("", "Фильм (1999)", "movie"), "1999"), (("", "Фильм (1999)", "series"), "")], titles.programme_year)
    got = table(spark, [("IMDb: 7,5 tt0133093", None)], lambda d: titles.existing_imdb(d, none, L(None)))[0]
    assert (got.rating, got.imdb_id) == ("7.5", "tt0133093")


def test_language_gate_of_words_beside_accents(spark, tmp_path):
    import duckdb

    from tidemark.plans import oracles, queries

    texts = ["Éon.", "Êa.", "Ña.", "À.", "Äon, ö.", "a²", "_a", "É a.", "ÉOF.", "The.", "Von.", "", None, "12"]
    rows = [(k, text, lang) for k, (text, lang) in enumerate((t, g) for t in texts for g in ("fr", "en", None))]
    spark.createDataFrame(rows, "doc_id int, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = sorted(tuple(r) for r in queries.language_gate(spark, str(tmp_path)).collect())
    assert got == sorted(duck.execute(oracles.ORACLES["language_gate"]).fetchall())
    assert spark.createDataFrame([("Éon.",)], "t string").select(titles.detect_language(F.col("t"))).first()[0] == "unknown"
