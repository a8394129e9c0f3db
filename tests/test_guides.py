"""Guides as bytes: routing by the first bytes, elements that nobody knows, and the one file that comes out."""

import gzip
import re
import xml.etree.ElementTree as ET
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.functions.timeparse import shift
from tidemark.sources import guide_file, xmltv

HEAD = '<?xml version="1.0" encoding="UTF-8"?>\n<!DOCTYPE tv SYSTEM "xmltv.dtd">\n<tv generator-info-name="x">\n'
CHANNEL = '<channel id="c1"><display-name>One &amp; Two</display-name><icon src="i.png"/><lcn system="x">7</lcn></channel>'
SHOW = "<programme stop='20240101020000 +0000' start='20240101010000 +0000' channel=\"c1\"><title lang=\"en\">A &lt;b&gt; > c</title><star-rating><value>7/10</value></star-rating><!-- kept --><category>film</category></programme>"
SHORT = '<programme start="20240101020000 +0000" channel="c1" clumpidx="0/2"/>'
GUIDE = f"{HEAD}{CHANNEL}\n<!-- <programme channel='no'>out</programme> -->\n{SHOW}\n{SHORT}</tv>"


def rows(spark, path):
    e = xmltv.read_elements(spark, str(path))
    p = xmltv.programmes_of(e, F.lit(4)).orderBy("nth").collect()
    c = xmltv.channels_of(e, F.lit(4)).collect()
    return [(r.source_index, r.channel, r.start, r.stop, r.title, r.lang, r.categories, r.raw) for r in p], [(r.source_index, r.id, r.display_names, r.raw) for r in c]


def test_three_files_give_the_same_rows(spark, tmp_path):
    (tmp_path / "plain.xml").write_text(GUIDE)
    (tmp_path / "compressed").write_bytes(gzip.compress(GUIDE[:200].encode()) + gzip.compress(GUIDE[200:].encode()))
    (tmp_path / "plain.xml.gz").write_text(GUIDE)
    got = [rows(spark, tmp_path / f) for f in ("plain.xml", "compressed", "plain.xml.gz")]
    assert got[0] == got[1] == got[2]
    assert got[0][0] == [(4, "c1", "20240101010000 +0000", "20240101020000 +0000", "A <b> > c", "en", ["film"], SHOW), (4, "c1", "20240101020000 +0000", None, "", "", [], SHORT)]
    assert got[0][1] == [(4, "c1", ["One & Two"], CHANNEL)]


def test_pieces_broken_and_empty_files(spark, tmp_path, monkeypatch):
    many = HEAD + "".join(f'<programme start="2024{k:010d}" channel="c{k % 3}"><title>{"t" * (k % 50)}</title></programme>' for k in range(400)) + "</tv>"
    cut = xmltv._cutter()
    import pyarrow as pa

    batch = lambda *contents: [pa.RecordBatch.from_arrays([pa.array([str(k) for k in range(len(contents))]), pa.array(contents, pa.binary())], ["path", "content"])]
    whole = [r for b in cut(batch(many.encode())) for r in b.to_pylist()]
    monkeypatch.setattr(xmltv, "PIECE", 37)
    assert [r for b in cut(batch(many.encode())) for r in b.to_pylist()] == whole and len(whole) == 400 and [r["nth"] for r in whole] == list(range(400))
    packed = gzip.compress(many.encode())
    assert [r["raw"] for b in cut(batch(packed)) for r in b.to_pylist()] == [r["raw"] for r in whole]
    short = [r["raw"] for b in cut(batch(packed[: len(packed) // 2], b"", None, b"\x1f\x8bnonsense", b"no guide at all" * 50)) for r in b.to_pylist()]
    assert 0 < len(short) < 400 and short == [r["raw"] for r in whole][: len(short)]


def test_unknown_elements_survive_read_shift_and_write(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_bytes(gzip.compress(GUIDE.encode()))
    e = xmltv.read_elements(spark, str(tmp_path / "in"))
    p = xmltv.programmes_of(e, F.lit(0))
    later = xmltv.retimed(p, shift(F.col("start"), F.lit(90)), shift(F.col("stop"), F.lit(90)), F.lit('o"1'))
    channels = xmltv.channels_of(e, F.lit(0)).select(F.col("id").alias("output_tvg_id"), "display_names", "raw")
    out = tmp_path / "out.xml.gz"
    xmltv.write_guide(channels, later, str(out))
    root = ET.fromstring(gzip.decompress(out.read_bytes()))
    assert [x.tag for x in root] == ["channel", "programme", "programme"]
    show = root[1]
    assert show.attrib == {"start": "20240101023000 +0000", "stop": "20240101033000 +0000", "channel": 'o"1'} and show.find("star-rating/value").text == "7/10" and root[0].find("lcn").text == "7"
    assert root[2].attrib == {"start": "20240101033000 +0000", "channel": 'o"1', "clumpidx": "0/2"}
    assert re.sub(r"(start|stop|channel)=(\"[^\"]*\"|'[^']*')", "", gzip.decompress(out.read_bytes()).decode()).count("<!-- kept -->") == 1


def table(spark, n=300):
    p = spark.createDataFrame([(f"c{k % 7}", f"20240{1 + k % 3}01{k:06d} +0000", None, f"T {k} <&>", None, ["a", "b"][: k % 3]) for k in range(n)], "channel string, start string, stop string, title string, desc string, categories array<string>")
    c = spark.createDataFrame([(f"c{k}", [f"C {k}", "x"]) for k in (3, 1, 2)], "output_tvg_id string, display_names array<string>")
    return c, p


def test_equal_tables_give_equal_bytes(spark, tmp_path):
    c, p = table(spark)
    xmltv.write_guide(c, p, f"{tmp_path}/one.xml.gz")
    xmltv.write_guide(c.repartition(3), p.repartition(9, "title"), f"file://{tmp_path}/two.xml.gz")
    one, two = (Path(f"{tmp_path}/{n}.xml.gz").read_bytes() for n in ("one", "two"))
    assert one == two and not list(Path(f"{tmp_path}/one.xml.gz.members").iterdir())
    root = ET.fromstring(gzip.decompress(one))
    keys = [(x.tag, x.get("id") or x.get("channel"), x.get("start", "")) for x in root]
    assert keys == sorted(keys) and len(keys) == 303
    back = xmltv.read_programmes(spark, f"{tmp_path}/one.xml.gz", 0)
    assert sorted((r.channel, r.start, r.title) for r in back.collect()) == sorted((r.channel, r.start, r.title) for r in p.collect())
    assert sorted((r.id, r.display_names) for r in xmltv.read_channels(spark, f"{tmp_path}/one.xml.gz", 0).collect()) == [("c1", ["C 1", "x"]), ("c2", ["C 2", "x"]), ("c3", ["C 3", "x"])]
    assert {r.title for r in xmltv.programmes_of(xmltv.read_elements(spark, f"{tmp_path}/one.xml.gz"), F.lit(0)).collect()} == {r.title for r in p.collect()}


def test_a_guide_is_read_by_many_tasks(spark, tmp_path, monkeypatch):
    c, p = table(spark, 700)
    p = p.withColumn("start", F.concat(F.lit("20"), F.lpad((F.crc32("title") % 89 + 10).cast("string"), 2, "0"), F.substr("start", F.lit(5))))
    path = f"{tmp_path}/guide.xml.gz"
    xmltv.write_guide(c, p, path)
    content = Path(path).read_bytes()
    assert content.count(guide_file.HEADER) > 300 and b"".join(xmltv._inflated(content)) == gzip.decompress(content)
    columns = ["path", "kind", "raw"]
    whole = [tuple(r) for r in xmltv.read_elements(spark, path).orderBy("nth").select(*columns).collect()]
    assert len(whole) == 703 and [r.nth for r in xmltv.read_elements(spark, path).orderBy("nth").collect()] == list(range(703))
    monkeypatch.setattr(xmltv, "SLICE", 2000)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        dealt = xmltv.read_elements(spark, path)
        assert [tuple(r) for r in dealt.orderBy("nth").select(*columns).collect()] == whole
        assert dealt.select("path", "nth").distinct().count() == 703 and dealt.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_a_failed_run_leaves_the_old_guide(spark, tmp_path):
    c, p = table(spark, 20)
    path = f"{tmp_path}/guide.xml.gz"
    xmltv.write_guide(c, p, path)
    before = Path(path).read_bytes()
    with pytest.raises(Exception, match="broken"):
        xmltv.write_guide(c, p.withColumn("title", F.when(F.col("start").endswith("5 +0000"), F.raise_error(F.lit("broken")).cast("string")).otherwise(F.col("title"))), path)
    assert Path(path).read_bytes() == before
    xmltv.write_guide(c.limit(0), p.limit(0), path)
    assert gzip.decompress(Path(path).read_bytes()).startswith(b"<?xml") and len(ET.fromstring(gzip.decompress(Path(path).read_bytes()))) == 0
    assert guide_file.guide_format().name() == guide_file.NAME
