import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.operators import guide
from tidemark.plans import jobs


def test_build_guide(spark):
    now = F.lit("2026-08-17 19:00:00").cast("timestamp_ntz")
    c = spark.createDataFrame([(0, "Кино HD", "", "", "G"), (1, "Discovery Science RO", "", "", "Румыния"), (2, "None", "", "", "G")], "channel_index bigint, name string, tvg_id string, tvg_name string, grp string")
    feeds = spark.createDataFrame([(0, "A", [], [], False), (1, "B", [], ["RO"], False)], "source_index int, name string, groups array<string>, regions array<string>, require_region_for_id boolean")
    fc = spark.createDataFrame([(0, "kino", ["Кино"]), (0, "stale", ["None"]), (1, "disc.ro", ["Discovery Science"])], "source_index int, id string, display_names array<string>")
    p = spark.createDataFrame([(0, "kino", "20260817190000 +0000", "20260817200000 +0000", "T"), (0, "stale", "20260701190000 +0000", "20260701200000 +0000", "T"), (1, "disc.ro", "20260817210000 +0300", "20260817230000 +0300", "D")], "source_index int, channel string, start string, stop string, title string")
    empty = lambda s: spark.createDataFrame([], s)
    g = jobs.build_guide(
        c, feeds, fc, p, empty("ord bigint, name string, source string, grp string, region string, target_id string, hard_pin string"), empty("enabled string, playlist_name string, new_tvg_id string, ord bigint"),
        spark.createDataFrame([("A", "kino", 60)], "source string, source_id string, offset_minutes int"), empty("playlist_name string, source_id string, status string, reason string, evidence_url string"), now, "America/Los_Angeles",
    )
    m = {r.playlist_name: (r.output_tvg_id, r.method, r["pass"]) for r in g.mapping.collect()}
    assert m == {"Кино HD": ("kino", "name", 1), "Discovery Science RO": ("disc.ro", "family-region", 2)}
    assert {r.channel: r.start for r in g.programmes.collect()} == {"kino": "20260817130000 -0700", "disc.ro": "20260817110000 -0700"}
    assert {r.output_tvg_id: r.display_names[0] for r in g.channels.collect()} == {"kino": "Кино HD", "disc.ro": "Discovery Science RO"}
    assert [r.name for r in g.unresolved.collect()] == ["None"]
    assert {r.grp: (r.total, r.matched) for r in g.coverage.collect()} == {"G": (2, 1), "Румыния": (1, 1)}


def test_enrichment(spark):
    p = spark.createDataFrame([(0, "c", "т/с След (Один)", "", [], False, ""), (1, "c", "т/с След (Два)", "", [], False, ""), (2, "c", "Новости", "", [], False, "")], "ord int, channel string, title string, lang string, categories array<string>, has_episode boolean, date string")
    groups = spark.createDataFrame([("c", "G")], "output_tvg_id string, grp string")
    q = jobs.title_queries(p, groups, [])
    assert {(r.ord, r.key_title, r.media) for r in q.collect()} == {(0, "След", "series"), (1, "След", "series")}
    titles = spark.createDataFrame([(7, "след", "2007", "series")], "title_id int, norm string, year string, media string")
    aliases = spark.createDataFrame([], "alias string, year string, media string, title_id int, confidence int")
    found = "struct<title:string,year:string,rating:string,imdb_id:string,overview:string,poster:string,genre_ids:array<int>,genres:array<string>>"
    details = spark.createDataFrame([(7, ("След", "2007", "6.0", "tt1234567", "o", "p", [18], []))], f"title_id int, found {found}")
    full = p.withColumns({"desc": F.lit(""), "rating": F.lit(None).cast("array<struct<system:string,value:string>>"), "url": F.lit(None).cast("array<string>"), "icon": F.lit("")})
    got = {r.ord: r.title for r in jobs.enrich_guide(full, q, aliases, titles, details).collect()}
    assert got == {0: "След (2007) · IMDb 6.0", 1: "След (2007) · IMDb 6.0", 2: "Новости"}
    states = spark.createDataFrame([], "norm string, year string, media string, language string, state string")
    assert [(r.title, r.state) for r in jobs.backfill_plan(q, states, 5).collect()] == [("След", "unknown")]


def build_inputs(spark, n, hours=(19, 20)):
    ids = [f"c{k}" for k in range(n)]
    feeds = spark.createDataFrame([(0, "A", [], [], False)], "source_index int, name string, groups array<string>, regions array<string>, require_region_for_id boolean")
    programmes = [(0, i, f"20260817{h}0000 +0000", f"20260817{h + 1}0000 +0000", "T", f'<programme start="20260817{h}0000 +0000" stop="20260817{h + 1}0000 +0000" channel="{i}"><title>T</title><odd/></programme>') for i in ids for h in hours]
    empty = lambda s: spark.createDataFrame([], s)
    return {
        "channels": spark.createDataFrame([(k, f"N{k}", i, "", "G", f"http://example.test/{k}") for k, i in enumerate(ids)], "channel_index bigint, name string, tvg_id string, tvg_name string, grp string, url string"),
        "feeds": feeds, "feed_channels": spark.createDataFrame([(0, i, [i]) for i in ids], "source_index int, id string, display_names array<string>"),
        "programmes": spark.createDataFrame(programmes, "source_index int, channel string, start string, stop string, title string, raw string"), "aliases": empty("ord bigint, name string, source string, grp string, region string, target_id string, hard_pin string"),
        "id_fixes": empty("enabled string, playlist_name string, new_tvg_id string, ord bigint"), "offsets": empty("source string, source_id string, offset_minutes int"),
        "overrides": empty("playlist_name string, source_id string, status string, reason string, evidence_url string"), "now": F.lit("2026-08-17 19:00:00").cast("timestamp_ntz"),
    }


def test_build_run_and_its_gates(spark, tmp_path):
    folder = f"{tmp_path}/out"
    full = build_inputs(spark, 120)
    first = jobs.build_run(**full, folder=folder, run_id="r1", zone="America/Los_Angeles")
    assert tuple(first.status.first()) == (120, 120, 0, 240) and first.changes.groupBy("change").count().collect()[0]["count"] == 120
    guide_file = Path(folder) / "guide.xml.gz"
    before = guide_file.read_bytes()
    text = gzip.decompress(before).decode()
    assert text.count("<odd/>") == 240 and text.count('start="20260817120000 -0700"') == 120 and text.count("<channel") == 120

    def refused(match, **more):
        with pytest.raises(guide.GateClosed, match=match):
            jobs.build_run(**full | more, folder=folder, run_id="r2")
        assert guide_file.read_bytes() == before and {r.run_id for r in spark.read.parquet(f"{folder}/history").collect()} == {"r1"}

    refused("channels: 50 after 120", channels=full["channels"].limit(50))
    refused("no channels", channels=full["channels"].limit(0))
    refused("no programmes", programmes=full["programmes"].limit(0))
    again = jobs.build_run(**full | {"channels": full["channels"].where("channel_index < 110")}, folder=folder, run_id="r2")
    assert tuple(again.status.first()) == (110, 110, 0, 220) and {r.change for r in again.changes.collect()} == {"removed"}
    assert [(r.source, r.runs, r.total_added) for r in again.ranking.collect()] == [("A", 2, 230)]
    assert guide_file.read_bytes() != before


def test_programmes_gate(spark, tmp_path):
    folder = f"{tmp_path}/out"
    spark.createDataFrame([(5, 5, 0, 1000, "r0")], jobs.STATUS).write.partitionBy("run_id").parquet(f"{folder}/status")
    with pytest.raises(guide.GateClosed, match="programmes: 20 after 1000"):
        jobs.build_run(**build_inputs(spark, 10), folder=folder, run_id="r1")
    assert not (Path(folder) / "guide.xml.gz").exists()
    assert jobs.build_run(**build_inputs(spark, 10), folder=folder, run_id="r1", programmes_share=0.01).status.first().programmes == 20
