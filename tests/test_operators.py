import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import audit, enrich, guide, resolve, similarity, store
from tidemark.operators.common import first_wins, last_wins, unique_only

FEED = "source_index int, name string, groups array<string>, regions array<string>, require_region_for_id boolean"
ALIAS = "ord bigint, name string, source string, grp string, region string, target_id string, hard_pin string"
CHANNEL = "channel_index bigint, name string, tvg_id string, tvg_name string, grp string"
NAMES = "source_index int, id string, norm string"


def resolved(spark, channels, feeds, names, aliases=()):
    n = spark.createDataFrame(names, NAMES)
    found = resolve.resolve(spark.createDataFrame(channels, CHANNEL), spark.createDataFrame(feeds, FEED), n.select("source_index", "id").distinct(), n, spark.createDataFrame(list(aliases), ALIAS))
    return {(r.channel_index): (r.source, r.source_id, r.method, r.confidence, r["pass"]) for r in found.collect()}


def test_cascade(spark):
    ro = (1, "Discovery Science HD RO", "no_epg", "", "Румыния")
    feed = lambda r: (0, "f", [], r, False)
    assert resolved(spark, [ro], [feed(["RO"])], [(0, "disc.ro", "discovery science")]) == {1: ("f", "disc.ro", "family-region", 92, 2)}
    assert resolved(spark, [ro], [feed(["GB"])], [(0, "disc.ro", "discovery science")]) == {}
    a = (0, "Discovery Science HD RO", "f", "", "RO", "disc.ro", "")
    assert resolved(spark, [ro], [feed(["RO"])], [(0, "disc.ro", "x")], [a])[1] == ("f", "disc.ro", "alias", 100, 1)


def test_pins_and_vetoes(spark):
    c = (1, "Premium HD", "p1", "", "X")
    feeds = [(0, "A", [], [], False), (1, "B", [], [], False)]
    names = [(0, "p1", "p1"), (1, "premium-hd", "q")]
    pin = (0, "Premium HD", "B", "", "", "premium-hd", "1")
    assert resolved(spark, [c], feeds, names)[1] == ("A", "p1", "id", 99, 1)
    assert resolved(spark, [c], feeds, names, [pin])[1] == ("B", "premium-hd", "alias", 100, 1)
    veto = [(0, "A", [], ["RO"], True), (1, "B", [], [], False)]
    # a vetoed id also closes the name rule in that feed
    assert resolved(spark, [c], veto, [(0, "p1", "premium"), (1, "z", "premium")])[1] == ("B", "z", "name", 90, 1)


def test_names_must_be_unique(spark):
    c = (1, "Two", "", "", "X")
    assert resolved(spark, [c], [(0, "A", [], [], False)], [(0, "a", "two"), (0, "b", "two")]) == {}
    assert resolved(spark, [], [(0, "A", [], [], False)], [(0, "a", "two")]) == {}


def test_picks(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, None)], "k string, o int, v string")
    assert {r.k: r.v for r in last_wins(df, ["k"], "o").collect()} == {"a": "y", "b": None}
    assert {r.k: r.v for r in first_wins(df, ["k"], "o").collect()} == {"a": "x", "b": None}
    assert [r.k for r in unique_only(df.na.fill("z"), ["k"], "v").collect()] == ["b"]


def test_clock_offsets(spark):
    rules = spark.createDataFrame([("o", "cps-*", 60), ("o", "cps-d*", 90), ("o", "cps-drama", 120), ("o", "cps-zero", 0)], "source string, source_id string, offset_minutes int")
    ids = spark.createDataFrame([("o", "cps-drama"), ("o", "cps-ussr"), ("o", "cps-dx"), ("o", "cps-zero"), ("r", "cps-ussr")], "source string, source_id string")
    got = {(r.source, r.source_id): r.offset_minutes for r in guide.clock_offsets(ids, rules).collect()}
    assert got == {("o", "cps-drama"): 120, ("o", "cps-ussr"): 60, ("o", "cps-dx"): 90, ("o", "cps-zero"): 0, ("r", "cps-ussr"): 0}


def test_second_pass_fills_needs_only(spark):
    p = spark.createDataFrame([(0, "a", True, False), (1, "b", True, True), (2, "c", True, True)], "source_index int, channel string, kept boolean, usable boolean")
    second = spark.createDataFrame([(0, "a", "o1"), (1, "b", "o1"), (2, "c", "o1"), (1, "b", "o2")], "source_index int, source_id string, output_tvg_id string")
    counts = spark.createDataFrame([("o2", 5, 1)], "output_tvg_id string, programmes int, usable int")
    got = sorted((r.output_tvg_id, r.source_index) for r in guide.fan_out_needed(p, second, counts).collect())
    assert got == [("o1", 0), ("o1", 1)]


def test_gates(spark):
    guide.gate_drop(100, 90, 100, 0.85, "channels")
    guide.gate_drop(50, 1, 100, 0.85, "channels")
    for previous, current in ((100, 84), (0, 0)):
        with pytest.raises(guide.GateClosed):
            guide.gate_drop(previous, current, 100, 0.85, "channels")
    with pytest.raises(guide.GateClosed):
        guide.gate_header(spark.range(1), ["tconst"])


def assessed(spark, row, overrides=()):
    m = spark.createDataFrame([row], "playlist_name string, source string, source_id string, output_tvg_id string, region string, method string, confidence int")
    o = audit.overrides_of(spark.createDataFrame(list(overrides), "ord int, enabled string, playlist_name string, source_id string, status string, reason string, evidence_url string"))
    feeds = spark.createDataFrame([(0, "f", [], ["GB"], False)], FEED)
    r = audit.assess(m, feeds, o).first()
    return r.accuracy_status, r.quarantine


def test_accuracy(spark):
    assert assessed(spark, ("XZoom", "s", "XZoom.il", "x", "UA", "id", 99)) == ("wrong", True)
    assert assessed(spark, ("НТВ", "s", "Xntv", "x", "RU", "id", 99)) == ("probable", False)
    assert assessed(spark, ("D", "s", "d", "d", "", "synthetic-ditv", 50)) == ("wrong", True)
    assert assessed(spark, ("HBO", "f", "h", "h", "RO", "name", 90)) == ("wrong", True)
    assert assessed(spark, ("A", "s", "a", "a", "", "alias", 100)) == ("verified", False)
    wild = (0, "1", "D", "", "verified", "seen", "")
    assert assessed(spark, ("D", "s", "d", "d", "", "synthetic-ditv", 50), [wild]) == ("verified", False)


def test_snapshot_diff(spark):
    s = "ord int, name string, tvg_id string, grp string, url string"
    old = spark.createDataFrame([(0, "A", "a", "g", "u1"), (1, "B", "b", "g", "u")], s)
    new = spark.createDataFrame([(0, "A2", "a", "g2", "u2"), (1, "C", "c", "g", "u")], s)
    assert sorted(r.change for r in audit.snapshot_diff(old, new).collect()) == ["added", "group", "removed", "renamed", "url"]
    assert audit.snapshot_diff(old, old).count() == 0


def test_delivery(spark):
    d = spark.createDataFrame([(0, "A", "wrong", None, "g"), (1, "P", "", "hint", "prot"), (2, "Q", "No_EPG_7", None, "g"), (3, "G", "ok", None, "g"), (4, "G", "ok", None, "g")], "ord int, name string, tvg_id string, tvg_name string, grp string")
    e = spark.createDataFrame([(0, "A", "a"), (1, "M", "m"), (2, "G", "ok")], "ord int, playlist_name string, output_tvg_id string")
    v = spark.createDataFrame([("ok",), ("m",), ("",)], "output_tvg_id string")
    got = {(r.name, r.issues, r.validated, r.copies) for r in audit.delivery_audit(d, e, v, ["prot"]).collect()}
    assert got == {
        ("A", "wrong_tvg_id;no_validated_programme", False, 1), ("P", "protected_unmatched_has_epg_hint", False, 1), ("Q", "placeholder_tvg_id_left", False, 1), ("G", "ok", True, 2),
        ("M", "mapped_channel_missing_from_worker", True, 0),
    }
    assert {r.issue: r.n for r in audit.issue_counts(audit.delivery_audit(d, e, v, ["prot"])).collect()} == {"wrong_tvg_id": 1, "no_validated_programme": 1, "protected_unmatched_has_epg_hint": 1, "placeholder_tvg_id_left": 1, "mapped_channel_missing_from_worker": 1}


def test_watchlist(spark):
    t = lambda h: dt.datetime(2026, 8, 17, h)
    p = spark.createDataFrame([("c", "old", t(1), t(10)), ("c", "now", t(9), t(11)), ("c", "next", t(11), None)], "channel string, title string, start_at timestamp_ntz, stop_at timestamp_ntz")
    m = spark.createDataFrame([(0, "N", "x"), (1, "N", "c")], "ord int, playlist_name string, output_tvg_id string")
    names = spark.createDataFrame([("N",), ("?",)], "name string")
    got = {r.name: (r.status, r.on_air, list(r.upcoming)) for r in audit.watchlist(names, m, p, F.lit("2026-08-17 09:30:00").cast("timestamp_ntz")).collect()}
    assert got == {"N": ("ok", "now", ["next"]), "?": ("not_mapped", None, [])}


def test_families(spark):
    d = spark.createDataFrame([(k, n, "g", False) for k, n in enumerate(["Clarity4K Cinema", "BrandX Cinema", "BrandX Action", "", "7"])], "ord int, name string, grp string, dummy boolean")
    got = {r.family: r.n for r in audit.family_report(d).collect()}
    assert got == {"Clarity": 1, "Other: BrandX": 2, "(empty-name)": 1, "Other": 1}


def test_alias_learning(spark):
    s = "ord int, alias string, year string, media string, identity string, confidence int, verified int, source string"
    e = spark.createDataFrame([(0, "a", "", "m", "t1", 98, 0, "x"), (1, "a", "", "m", "t1", 99, 1, "y"), (2, "a", "", "m", "t2", 100, 1, "z")], s)
    known, clash = store.learn_aliases(e)
    r = known.first()
    assert (r.identity, r.evidence_count, r.confidence, r.verified, r.source) == ("t1", 2, 99, 1, "y")
    assert [(c.first_identity, c.identity, c.n) for c in clash.collect()] == [("t1", "t2", 1)]


def test_programmes_of_one_start_stand_in_their_order(spark):
    now = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    rows = [(ch, f"t{k}", f"2024-01-15 1{3 + k // 4}:00:00", k) for ch in "abcdefgh" for k in range(12)]
    p = spark.createDataFrame(rows, "channel string, title string, start string, ord int").withColumns({"start_at": F.col("start").cast("timestamp_ntz"), "stop_at": F.lit(None).cast("timestamp_ntz")})
    for turned in (p.orderBy("ord"), p.orderBy(F.desc("ord"))):
        got = guide.next_programmes(turned.coalesce(1), now, 6, ["ord"]).select("channel", "place", "title").collect()
        assert sorted(tuple(r) for r in got) == [(ch, k + 1, f"t{k}") for ch in "abcdefgh" for k in range(6)]
        on = guide.current_programme(turned, F.lit("2024-01-15 13:30:00").cast("timestamp_ntz"), ["ord"]).select("channel", "title").collect()
        assert sorted(tuple(r) for r in on) == [(ch, "t3") for ch in "abcdefgh"]
        names = spark.createDataFrame([("A",)], "name string")
        m = spark.createDataFrame([(0, "A", "a")], "ord int, playlist_name string, output_tvg_id string")
        assert audit.watchlist(names, m, turned, now, 5).first().upcoming == [f"t{k}" for k in range(5)]


def test_merge_keeps_known_values(spark):
    s = "k string, a string, b string, o int"
    got = store.merge_nonempty(spark.createDataFrame([("x", "old", "old", 1)], s), spark.createDataFrame([("x", "", "", 2)], s), ["k"], "o", overwrite=["b"]).first()
    assert (got.a, got.b) == ("old", "")
    twice = store.merge_nonempty(spark.createDataFrame([("x", "old", "b", 1)], s), spark.createDataFrame([], s), ["k"], "o")
    assert tuple(twice.first()) == tuple(store.merge_nonempty(twice.select("k", "a", "b", "o"), spark.createDataFrame([], s), ["k"], "o").first())


def test_credits(spark):
    s = "ord int, title_id int, name string, role string, character string, billing int"
    got = store.cast_and_directors(spark.createDataFrame([(0, 1, "Ridley", "director", "", None), (1, 1, "Jeff", "actor", "T", 2), (2, 1, "Matt", "actor", "W", 1), (3, 1, "X", "actor", "", None)], s), 2).first()
    assert got.directors == ["Ridley"] and [a.name for a in got.actors] == ["Matt", "Jeff"]


def test_negative_cache(spark):
    rows = [("not_found", 4, 10, True), ("not_found", 4, 31, False), ("found", 1, 900, True), ("no_imdb_id", 1, 15, False), ("error", 1, 2, True)]
    df = spark.createDataFrame([(a, b, dt.datetime(2026, 1, 1) - dt.timedelta(days=c)) for a, b, c, _ in rows], "s string, m int, t timestamp_ntz")
    got = [r[0] for r in df.select(store.negative_is_fresh(F.col("s"), F.col("m"), F.col("t"), F.lit("2026-01-01").cast("timestamp_ntz"))).collect()]
    assert got == [x[3] for x in rows]


def test_cut_off(spark):
    df = spark.createDataFrame([("q", k, h) for k, h in enumerate([False, False, False, True])], "q string, p int, hit boolean")
    assert enrich.until_cut_off(df, "q", "p", "hit", 2).count() == 2
    assert enrich.until_cut_off(df, "q", "p", "hit", 4).count() == 4


def test_queue_takes_an_episode_once(spark):
    s = "ord int, channel string, priority int, title string, year string, media string, language string, grp string"
    rows = [(k, "c", 2, "След", "", "series", "ru", "g") for k in range(3)]
    assert enrich.queue(spark.createDataFrame(rows, s)).count() == 1


def test_rendering(spark):
    s = "title string, desc string, categories array<string>, date string, rating array<struct<system:string,value:string>>, url array<string>, icon string, found struct<title:string,year:string,rating:string,imdb_id:string,overview:string,poster:string,genre_ids:array<int>,genres:array<string>>"
    row = ("х/ф Матрица", "d", ["x"], "1999", None, None, None, ("Матрица", "1999", "8.7", "tt0133093", "o", "p", [28], ["Drama"]))
    once = enrich.render(spark.createDataFrame([row], s))
    r = once.first()
    assert r.title == "Матрица (1999) · IMDb 8.7" and r.date is None and r.categories == [] and r.genre == "боевик, драма"
    assert enrich.render(once).first() == r


def test_rules_by_hand(spark):
    p = spark.createDataFrame([(0, "х/ф Долгий (1999)", 435, ["Kino"]), (1, "Долгий", 60, ["Kino"]), (2, "Иной", 500, ["Kino"])], "ord int, title string, minutes int, names array<string>")
    r = spark.createDataFrame([(0, "r", "долгий", 400, ["kino"])], "rule_ord int, id string, title_base string, min_minutes int, needles array<string>")
    assert {x.ord: x.rule_id for x in enrich.apply_rules(p, r).collect()} == {0: "r", 1: None, 2: None}


def test_candidates(spark):
    q = spark.createDataFrame([(1, "Martian", "2015", "movie", "localized+year")], "query_id int, title string, year string, media string, label string")
    cat = lambda y: spark.createDataFrame([(7, 0, "Martian", "Martian", y, "movie")], "id int, pos int, title string, original_title string, year string, media string")
    hit = similarity.best_candidates(q, cat("2015")).first()
    assert (hit.id, hit.similarity, hit.confidence) == (7, 1.0, 100)
    assert similarity.best_candidates(q, cat("1998")).count() == 0


def test_guards(one):
    L = F.lit  # noqa: N806
    safe = lambda raw, query, found, label, conf: one(similarity.safe_match(L(raw), L(query), [L(found)], L(label), L(conf)))
    assert safe("т/с Лютый 2. 1 с.", "Lyutyy", "Lyutyy", "translit+year", 99) is False
    assert safe("т/с Лютый 2. 1 с.", "Lyutyy 2", "Lyutyy", "translit+year", 99) is True
    assert safe("т/с Лютый 2. 1 с.", "Lyutyy 2", "Lyutyy", "translit+year", 95) is False and safe("т/с Лютый 2. 1 с.", "Lyutyy 2", "Lyutyy 2", "translit+year", 99) is False
    assert safe("Динотопия, 2 с", "Dinotopiya", "Dinotopiya", "translit-no-year", 97) is True  # the 2 is an episode
    assert safe("Люди в черном 3", "Lyudi v chernom", "Lyudi v chernom", "translit-no-year", 99) is False
    assert safe("Купель дьявола (2024)", "Kupel dyavola", "Kupel dyavola", "translit+year", 98) is True  # years don't count
    assert safe("Купель дьявола", "Kupel dyavola", "The Bath", "translit+year", 98) is False
    assert safe("Кремень. Освобождение", "Кремень", "Кремень", "series-root+year", 98) is False
    assert safe("Кремень. Сезон 2", "Кремень", "Кремень", "series-root+year", 98) is True and safe("Наш спецназ. Юг", "Наш спецназ", "x", "series-root+year", 1) is True
    assert safe("Кремень. Освобождение", "x", "y", "localized+year", 1) is True
    assert one(similarity.threshold(L("Дом"), L("")), similarity.threshold(L("Дом мечты"), L("")), similarity.threshold(L("Дом"), L("1999"))) == (0.92, 0.82, 0.82)
