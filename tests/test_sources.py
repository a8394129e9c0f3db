import gzip
import json

from pyspark.sql import functions as F

from tidemark.functions.timeparse import instant
from tidemark.sources import datasets, playlist, rules, xmltv


def test_m3u(spark, tmp_path):
    (tmp_path / "p.m3u").write_text(
        '﻿#EXTM3U\n#EXTINF:-1 tvg-id="lost",Lost\n#EXTINF:-1 tvg-id="bar" group-title="Wrong",Bar\n#EXTGRP:News\nhttp://example.test/bar.m3u8\n\n#EXTINF:0 tvg-name="Fallback" group-title="G",\nhttp://example.test/2\nhttp://example.test/stray\n#EXTINF:0 tvg-name="Only"\nhttp://example.test/3\n#EXTINF:0 tvg-name="A, B",C\nhttp://example.test/4\n'
    )
    rows = playlist.parse_m3u(playlist.read_lines(spark, str(tmp_path / "p.m3u"))).orderBy("channel_index").collect()
    assert [(r.channel_index, r.name, r.tvg_id, r.grp, r.stream_url) for r in rows] == [(0, "Bar", "bar", "News", "http://example.test/bar.m3u8"), (1, "", "", "G", "http://example.test/2"), (2, "Only", "", "", "http://example.test/3"), (3, 'B",C', "", "", "http://example.test/4")]


def test_playlist_in_many_files(spark, tmp_path):
    adaptive, parts = "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions"
    before = spark.conf.get(adaptive), spark.conf.get(parts)
    spark.conf.set(adaptive, "false")
    spark.conf.set(parts, "37")
    try:
        n = F.col("id").cast("string")
        blocks = spark.range(500).select(F.col("id").alias("ord"), F.concat(F.lit("#EXTINF:-1,N"), n).alias("extinf"), F.concat(F.lit("#EXTGRP:G"), n).alias("extgrp"), F.concat(F.lit("http://example.test/"), n).alias("url"))
        playlist.write_playlist(blocks, str(tmp_path / "p"))
        assert len(list((tmp_path / "p").glob("part-*"))) > 20
        back = playlist.parse_m3u(playlist.read_lines(spark, str(tmp_path / "p"))).collect()
    finally:
        spark.conf.set(adaptive, before[0])
        spark.conf.set(parts, before[1])
    assert sorted((int(r.name[1:]), r.grp, r.stream_url) for r in back) == [(k, f"G{k}", f"http://example.test/{k}") for k in range(500)]


def test_xmltv(spark, tmp_path):
    text = '<tv><channel id="cps-ussr"><display-name>CPS USSR</display-name><display-name>CPS</display-name></channel><programme channel="cps-ussr" start="20260821130700 -0700" stop="20260821143800 -0700"><title lang="ru">T</title><category>film</category><rating system="imdb"><value>7.1</value></rating></programme></tv>'
    with gzip.open(tmp_path / "g.xml.gz", "wt") as f:
        f.write(text)
    c = xmltv.name_rows(xmltv.read_channels(spark, str(tmp_path / "g.xml.gz"), 3))
    assert sorted(r.norm for r in c.collect()) == ["cps", "cps ussr"]
    p = xmltv.read_programmes(spark, str(tmp_path / "g.xml.gz"), 3).withColumn("at", instant(F.col("start"))).first()
    assert (p.channel, p.title, p.lang, p.categories, p.rating[0].value, str(p.at)) == ("cps-ussr", "T", "ru", ["film"], "7.1", "2026-08-21 20:07:00")
    assert xmltv.split_by_magic(spark, str(tmp_path)).first().is_gzip


def test_rule_files(spark, tmp_path):
    (tmp_path / "o.csv").write_text("enabled,source,source_id,offset_minutes,notes\n1,o,cps-*,60,\n0,o,x,5,\n1,o,b*d,5,\n1,o,late,20000,\n,o,blank,-30,\n")
    got = {r.source_id: r.offset_minutes for r in rules.read_offsets(spark, str(tmp_path / "o.csv")).collect()}
    assert got == {"cps-*": 60, "blank": -30}
    assert rules.read_rules(spark, str(tmp_path / "none.csv"), rules.ID_FIX).count() == 0
    (tmp_path / "s.json").write_text(json.dumps([{"xmltv": "u0", "regions": ["RO"]}, {"url": "u1", "name": "n", "enabled": False}, {"epg_url": "u2", "id": "i", "group_scope": ["g"], "require_region_for_id": True}]))
    feeds = rules.read_feeds(spark, str(tmp_path / "s.json")).orderBy("source_index").collect()
    assert [(f.source_index, f.url, f.name, f.groups, f.regions, f.require_region_for_id) for f in feeds] == [(0, "u0", "source-0", [], ["RO"], False), (2, "u2", "i", ["g"], [], True)]
    (tmp_path / "a.json").write_text(json.dumps({"aliases": {"Лютый": ["лютый HD", "Fierce", "Fierce"], "X": "Y"}}))
    assert {r.norm: r.aliases for r in rules.read_title_aliases(spark, str(tmp_path / "a.json")).collect()} == {"лютый": ["Fierce"], "x": ["Y"]}
    (tmp_path / "w.json").write_text(json.dumps({"channels": [" A ", "", "B"]}))
    assert sorted(r.name for r in rules.read_watchlist(spark, str(tmp_path / "w.json")).collect()) == ["A", "B"]


def test_datasets(spark, tmp_path):
    (tmp_path / "b.tsv").write_text("\t".join(datasets.BASICS) + "\ntt0133093\tmovie\tThe Matrix\tThe Matrix\t0\t1999\t\\N\t136\tAction,Sci-Fi\nnm1\tx\tx\tx\t0\t\\N\t\\N\t\\N\t\\N\n")
    (tmp_path / "r.tsv").write_text("\t".join(datasets.RATINGS) + "\ntt0133093\t8.7\t2200000\ntt0000002\t5.0\tx\n")
    from tidemark.operators.store import reference_titles

    row = reference_titles(datasets.read_basics(spark, str(tmp_path / "b.tsv")), datasets.read_ratings(spark, str(tmp_path / "r.tsv"))).collect()
    assert len(row) == 1 and (row[0].genres, row[0].rating, row[0].votes, row[0].endYear) == (["Action", "Sci-Fi"], "8.7", 2200000, None)


def test_legacy_caches(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"schema": 7, "entries": {"a|1999|movie|ru|x": {"status": "found", "imdb_id": "tt0133093"}, "b|||": {"status": "not_found"}}}))
    got = datasets.read_title_cache(spark, str(tmp_path / "c.json")).collect()
    assert [(r.norm, r.year, r.media, r.language) for r in got] == [("a", "1999", "movie", "ru|x")]
    (tmp_path / "e.json").write_text(json.dumps({"tt0133093": {"rating": "8.7", "votes": "1,000"}, "bad": {}}))
    got = datasets.read_entity_cache(spark, str(tmp_path / "e.json")).collect()
    assert [(r.imdb_id, r.votes, r.source) for r in got] == [("tt0133093", 1000, "imdb-dataset")]
    assert datasets.read_state(spark, str(tmp_path / "nothing"), "a int").count() == 0


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "n", "i", None)], "ord int, playlist_name string, output_tvg_id string, url string")
    datasets.write_csv(df, str(tmp_path / "csv"), ["playlist_name", "url", "missing"])
    assert tuple(spark.read.csv(str(tmp_path / "csv"), header=True).na.fill("").first()) == ("n", "", "")
    assert datasets.delivery_map(df).columns == ["playlist_name", "output_tvg_id"]
    for _ in range(2):
        datasets.append_run(df, str(tmp_path / "runs"), "r1")
    assert spark.read.parquet(str(tmp_path / "runs")).count() == 1
