"""Registered queries of reports and of the jobs that work on what is published, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import timeparse
from tidemark.operators import audit, guide, stored, store
from tidemark.plans import jobs
from tidemark.plans.job_queries import _ENRICH_SQL, _store_and_schedule
from tidemark.plans.oracles import _AT, _PROG
from tidemark.plans.queries import _channels, _now, _programmes
from tidemark.plans.store_queries import _table, _text
from tidemark.session import scratch
from tidemark.sources import xmltv

ORACLES: dict[str, str] = {}


def channel_diagnostics(spark: SparkSession, sf: str) -> DataFrame:
    """Watched channels with their mapping, counts, what is on, and the next three programmes, one row for each shown programme."""
    c, n = _channels(spark, sf), F.col("channel_index")
    broken = F.when(F.col("ord") % 9 == 0, "soon").otherwise(F.col("start"))
    p = _programmes(spark, sf).withColumn("start", broken).withColumns({"desc": F.lit(None).cast("string"), "categories": F.array(F.col("title"), F.lit(" "))})
    p = p.withColumns({"start_at": timeparse.instant(F.col("start")), "stop_at": timeparse.instant(F.col("stop"))})
    m = c.where(n % 2 == 0).select(n.alias("ord"), F.col("name").alias("playlist_name"), n.cast("string").alias("output_tvg_id"), "grp", F.lit("").alias("region"), F.lit("feed0").alias("source"), n.cast("string").alias("source_id"), F.lit("id").alias("method"))
    d = audit.channel_diagnostics(c.where(n % 3 == 0).select("name"), m, p, _now(), 3)
    shown = F.concat(F.array(F.col("current_programme")), F.coalesce("upcoming_programmes", F.array().cast(d.schema["upcoming_programmes"].dataType)))
    out = d.select("name", "matched", "status", "grp", "method", "programme_count", "parseable_programme_count", F.posexplode(shown).alias("place", "x"))
    return out.where("place = 0 OR x IS NOT NULL").select("name", "matched", "status", "grp", "method", "programme_count", "parseable_programme_count", "place", "x.start", "x.stop", "x.title", F.array_join("x.categories", "|").alias("categories"))


ORACLES["channel_diagnostics"] = f"""
    WITH {_PROG}, t AS (SELECT channel, CASE WHEN event_id % 9 <> 0 THEN start_at END AS start_at, stop_at, CASE WHEN event_id % 9 = 0 THEN 'soon' ELSE strftime(start_at, '%Y%m%d%H%M%S') || ' +0000' END AS start, strftime(stop_at, '%Y%m%d%H%M%S') || ' +0000' AS stop, title FROM secs),
    w AS (SELECT c_name AS name, c_custkey % 2 = 0 AS matched, CASE WHEN c_custkey % 2 = 0 THEN c_custkey::VARCHAR END AS channel, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS grp, CASE WHEN c_custkey % 2 = 0 THEN 'id' END AS method FROM customer WHERE c_custkey % 3 = 0),
    n AS (SELECT channel, count(*) AS a, count(start_at) AS b FROM t GROUP BY 1),
    shown AS (
        SELECT channel, 0 AS place, arg_max((start, stop, title), start_at) AS x FROM t WHERE start_at <= {_AT} AND (stop_at IS NULL OR stop_at > {_AT}) GROUP BY 1
        UNION ALL SELECT channel, place, x FROM (SELECT channel, row_number() OVER (PARTITION BY channel ORDER BY start_at) AS place, (start, stop, title) AS x FROM t WHERE start_at > {_AT}) WHERE place <= 3
    ), any_ AS (SELECT DISTINCT channel FROM shown), rows AS (SELECT name, matched, channel, grp, method, unnest([0, 1, 2, 3]) AS place FROM w)
    SELECT name, matched, CASE WHEN NOT matched THEN 'not_mapped' WHEN any_.channel IS NULL THEN 'no_current_or_upcoming_programme' ELSE 'ok' END AS status, grp, method, CASE WHEN matched THEN coalesce(a, 0) END AS programme_count, CASE WHEN matched THEN coalesce(b, 0) END AS parseable_programme_count, place::INT AS place, x[1] AS start, x[2] AS stop, x[3] AS title, x[3] AS categories
    FROM rows LEFT JOIN n USING (channel) LEFT JOIN any_ USING (channel) LEFT JOIN shown USING (channel, place) WHERE place = 0 OR x IS NOT NULL
"""


def recovery_queue(spark: SparkSession, sf: str) -> DataFrame:
    c, k = _table(spark, sf, "customer"), F.col("c_custkey")
    name = F.when(k % 4 == 0, _text("Канал ", k)).when(k % 4 == 1, _text("Їжак ", k)).when(k % 4 == 2, _text("Magic ", k)).otherwise(_text("Кино ", k))
    u = c.select(name.alias("name"), F.when(k % 7 == 0, "NO_EPG_1").otherwise("x").alias("tvg_id"), F.when(k % 3 == 0, "Новости").when(k % 3 == 1, "Россия").otherwise("Other").alias("grp"), F.when(k % 5 == 0, "BY").otherwise("").alias("region"))
    return audit.regional_queue(u, ["RU", "BY"], ["Россия", "Беларусь"], ["Новости"], ["Magic"]).select("name", "reason", "automatic_recovery_allowed")


ORACLES["recovery_queue"] = """
    WITH u AS (SELECT c_custkey AS k, CASE c_custkey % 4 WHEN 0 THEN 'Канал ' WHEN 1 THEN 'Їжак ' WHEN 2 THEN 'Magic ' ELSE 'Кино ' END || c_custkey AS name FROM customer),
    r AS (SELECT *, CASE WHEN k % 5 = 0 OR k % 3 = 1 THEN 'provider-region' WHEN k % 3 = 0 AND k % 4 IN (0, 3) THEN 'cyrillic-topical-group' END AS reason FROM u)
    SELECT name, reason, CASE WHEN k % 4 = 2 OR k % 7 = 0 THEN 'no' ELSE 'review' END AS automatic_recovery_allowed FROM r WHERE reason IS NOT NULL
"""


def coverage_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Coverage of groups, two of them rolled up, and the three that gained most."""
    c = _channels(spark, sf)
    m = c.where(F.col("channel_index") % 3 != 2).select("channel_index", (F.col("channel_index") % 3).alias("source_index"))
    covered = guide.coverage(c, m)
    two = guide.rollup_groups(covered, ["BUILDING", "MACHINERY"]).select(F.lit("BUILDING+MACHINERY").alias("grp"), "total", "baseline", "matched", "added")
    return two.unionByName(guide.top_coverage(covered, 3).select("grp", "total", "baseline", "matched", "added"))


ORACLES["coverage_rollup"] = """
    WITH c AS (SELECT c_mktsegment AS grp, count(*) AS total, count(*) FILTER (c_custkey % 3 = 0) AS baseline, count(*) FILTER (c_custkey % 3 <> 2) AS matched, count(*) FILTER (c_custkey % 3 = 1) AS added FROM customer GROUP BY 1)
    SELECT 'BUILDING+MACHINERY' AS grp, sum(total)::BIGINT AS total, sum(baseline)::BIGINT AS baseline, sum(matched)::BIGINT AS matched, sum(added)::BIGINT AS added FROM c WHERE grp IN ('BUILDING', 'MACHINERY')
    UNION ALL (SELECT * FROM c ORDER BY added DESC, grp LIMIT 3)
"""


def feed_name_index(spark: SparkSession, sf: str) -> DataFrame:
    s = _table(spark, sf, "supplier").select(F.lit(0).alias("source_index"), _text("id", F.col("s_suppkey")).alias("id"), _text("name ", F.col("s_suppkey") % 17).alias("norm"))
    return guide.name_index(s).select("source_index", "norm", F.array_join("ids", ",").alias("ids"), "n_ids")


ORACLES["feed_name_index"] = "SELECT 0::INT AS source_index, 'name ' || s_suppkey % 17 AS norm, string_agg('id' || s_suppkey, ',' ORDER BY 'id' || s_suppkey) AS ids, count(*) AS n_ids FROM supplier GROUP BY 2"


def verified_fixes(spark: SparkSession, sf: str) -> DataFrame:
    """Rules by hand over a schedule, then all compact titles made regular."""
    p, k = _table(spark, sf, "part"), F.col("p_partkey").cast("bigint")
    title = F.when(k % 3 == 0, F.concat(F.lit("х/ф "), "p_name", F.lit(" (1999)"))).when(k % 3 == 1, F.concat("p_name", F.lit(" 1999 (1999) · IMDb 7,5"))).otherwise(F.col("p_name"))
    programmes = p.select(k.alias("ord"), title.alias("title"), (F.col("p_size") * 10).cast("int").alias("minutes"), F.array(_text("Kino ", k % 4)).alias("names"), F.lit("").alias("date"), F.lit("old").alias("desc"), F.array(F.lit("film")).alias("categories"))
    names = p.select("p_name").distinct().where(F.length("p_name") % 2 == 0)
    rules = names.select(F.lit(0).alias("rule_ord"), F.concat(F.lit("r "), "p_name").alias("id"), F.col("p_name").alias("title_base"), F.lit(200).alias("min_minutes"), F.array(F.lit("KINO 1"), F.lit("kino 2")).alias("needles"), F.lit("1998").alias("year"), F.lit("8.1").alias("imdb_rating"), F.array(F.lit("film"), F.lit("драма")).alias("genres"), F.lit("").alias("description"))
    return jobs.verified_fixes(programmes, rules).select("ord", "title", "rule_id", "date", F.array_join("categories", ",").alias("categories"))


ORACLES["verified_fixes"] = """
    WITH p AS (SELECT p_partkey AS k, p_name, p_partkey % 3 AS kind, length(p_name) % 2 = 0 AND p_size * 10 >= 200 AND p_partkey % 4 IN (1, 2) AND p_partkey % 3 <> 1 AS ruled FROM part)
    SELECT k::BIGINT AS ord, CASE WHEN ruled THEN p_name || ' (1998) · IMDb 8.1' WHEN kind = 0 THEN 'х/ф ' || p_name || ' (1999)' WHEN kind = 1 THEN p_name || ' (1999) · IMDb 7.5' ELSE p_name END AS title,
        CASE WHEN ruled THEN 'r ' || p_name END AS rule_id, CASE WHEN ruled THEN '1998' ELSE '' END AS date, CASE WHEN ruled THEN 'film,драма' ELSE 'film' END AS categories FROM p
"""


def credits_load(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as credits: a customer number is the person, known by name, by id, or not yet; the first five actors of a title count."""
    s, n = _table(spark, sf, "supplier"), F.col("s_suppkey").cast("bigint")
    none = F.lit(None).cast("bigint")
    known = s.where(n % 3 != 2).select(n.alias("person_id"), F.when(n % 3 == 0, n * 10).otherwise(none).alias("tmdb_id"), F.lit("").alias("imdb_id"), _text("Supplier ", n).alias("name"), F.lit("{}").alias("extra"))
    o, k = _table(spark, sf, "orders"), F.col("o_orderkey").cast("bigint")
    person, line = F.col("o_custkey").cast("bigint") % 100, k % 7 + 1
    payload = o.select(k.alias("ord"), (F.floor(k / 7) % 60).alias("title_id"), (person * 10).alias("tmdb_id"), _text("supplier ", person).alias("name"), F.when(line == 1, "director").otherwise("actor").alias("role"), F.lit("").alias("character"), F.lit("").alias("job"), F.when(line % 3 != 0, line).cast("int").alias("billing"))
    empty = spark.createDataFrame([], "title_id bigint, person_id bigint, role string, character string, job string, billing int, ord bigint")
    after, credits = jobs.load_credits(known, empty, payload, 5)
    return credits.join(after.select("person_id", "tmdb_id", F.lower("name").alias("name")), "person_id").select("title_id", "person_id", "tmdb_id", "name", "role", "billing", "ord")


ORACLES["credits_load"] = """
    WITH p AS (SELECT o_orderkey AS ord, (o_orderkey // 7 % 60)::BIGINT AS title_id, (o_custkey % 100)::BIGINT AS s, CASE WHEN o_orderkey % 7 = 0 THEN 'director' ELSE 'actor' END AS role, CASE WHEN (o_orderkey % 7 + 1) % 3 <> 0 THEN o_orderkey % 7 + 1 END::INT AS billing FROM orders),
    w AS (SELECT * FROM p WHERE role = 'director' UNION ALL SELECT * FROM p WHERE role = 'actor' QUALIFY row_number() OVER (PARTITION BY title_id ORDER BY coalesce(billing, 999999), ord) <= 5),
    ids AS (SELECT s, CASE WHEN s % 3 <> 2 AND s IN (SELECT s_suppkey FROM supplier) THEN s ELSE (SELECT max(s_suppkey) FROM supplier WHERE s_suppkey % 3 <> 2) + 1 + min(ord) END::BIGINT AS person_id FROM w GROUP BY s)
    SELECT title_id, person_id, (s * 10)::BIGINT AS tmdb_id, 'supplier ' || s AS name, role, arg_max(billing, ord) FILTER (billing IS NOT NULL) AS billing, max(ord)::BIGINT AS ord FROM w JOIN ids USING (s) GROUP BY title_id, person_id, s, role
"""


def reapplied_guide(spark: SparkSession, sf: str) -> DataFrame:
    """A published guide with what the store knows written into it: titles change, children that nobody knows stay."""
    programmes, groups, aliases, titles, entities, seeds, _ = _store_and_schedule(spark, sf)
    esc = F.replace(F.col("title"), F.lit("'"), F.lit("&apos;"))
    raw = F.concat(F.lit('<programme start="20240115'), F.lpad((F.col("ord") % 1_000_000).cast("string"), 6, "0"), F.lit(' +0000" channel="'), "channel", F.lit('"><title>'), esc, F.lit("</title><country>US</country><odd n='"), F.col("ord").cast("string"), F.lit("'/>"), F.when(F.col("desc") != "", F.concat(F.lit("<desc>"), "desc", F.lit("</desc>"))).otherwise(""), F.lit("<category>misc</category></programme>"))
    shown = programmes.withColumns({"raw": raw, "start": F.concat(F.lit("20240115"), F.lpad((F.col("ord") % 1_000_000).cast("string"), 6, "0"), F.lit(" +0000")), "stop": F.lit(None).cast("string")})
    path = scratch(spark, "published")
    xmltv.write_guide(programmes.select(F.col("channel").alias("output_tvg_id"), F.array("channel").alias("display_names")).distinct(), shown, path)
    jobs.reapply(spark, path, groups, [], aliases, titles, entities, seeds, scratch(spark, "reapplied"))
    back = xmltv.programmes_of(xmltv.read_elements(spark, path), F.lit(0))
    odd = F.regexp_extract("raw", r"<odd n='(\d+)'/>", 1).cast("bigint")
    return back.select(odd.alias("ord"), "title", F.contains("raw", F.lit("<country")).alias("has_country"), F.size("categories").alias("n_categories"), F.coalesce(F.get(F.col("rating"), F.lit(0))["value"], F.lit("")).alias("rating"), F.regexp_extract(F.coalesce(F.get(F.col("url"), F.lit(0)), F.lit("")), r"(tt\d+)", 1).alias("imdb_id"))


_REAPPLY_SQL = _ENRICH_SQL.replace("titles >= 100 OR so_far >= 150", "true")
ORACLES["reapplied_guide"] = f"""{_REAPPLY_SQL}, o AS (SELECT p_partkey AS k, p_name || ' ' || p_type AS name FROM part WHERE p_partkey % 20 = 19)
    SELECT k::BIGINT AS ord, CASE WHEN shown THEN name || CASE WHEN outcome <> 'existing' AND id % 5 = 0 THEN ' (2001)' ELSE '' END || CASE WHEN rating <> '' THEN ' · IMDb ' || rating ELSE '' END ELSE title END AS title,
        NOT shown AS has_country, CASE WHEN shown THEN 0 ELSE 1 END::INT AS n_categories, CASE WHEN shown AND rating <> '' THEN rating || '/10' ELSE '' END AS rating, CASE WHEN outcome = 'existing' THEN 'tt0000001' WHEN shown THEN 'tt' || id + 1000000 ELSE '' END AS imdb_id FROM r
    UNION ALL SELECT k, name, true, 1, '', '' FROM o
"""


def stored_merge(spark: SparkSession, sf: str) -> DataFrame:
    """A stored table of customers after a merge that touches few of its buckets and a removal."""
    c, k = _table(spark, sf, "customer"), F.col("c_custkey").cast("bigint")
    rows = lambda where, name, ordinal: c.where(where).select(k.alias("id"), name.alias("name"), F.col("c_mktsegment").alias("segment"), ordinal.cast("bigint").alias("ord"))
    held = rows(k % 2 == 0, F.col("c_name"), k)
    path = scratch(spark, "stored")
    stored.create(held, path, ["id"])
    lowered = rows(k % 50 == 0, F.when(k % 100 == 0, "").otherwise(F.lower("c_name")), k + 1_000_000)
    new = lowered.withColumn("nth", F.lit(1)).unionByName(rows(k % 51 == 1, F.col("c_name"), k + 1_000_000).withColumn("nth", F.lit(2)))

    def merged(old: DataFrame, more: DataFrame) -> DataFrame:
        """Rows of one ordinal, as a customer in both parts of the new ones has, count in the order of their tables."""
        at = lambda df: df.withColumn("ord", F.struct("ord", "nth")).drop("nth")
        return store.merge_nonempty(at(old.withColumn("nth", F.lit(0))), at(more), ["id"], "ord").withColumn("ord", F.col("ord.ord"))

    stored.rewrite(path, new, held.schema, ["id"], merged)
    stored.remove(path, c.where(k % 30 == 0).select(k.alias("id")), held.schema, ["id"])
    return stored.read(spark, path, held.schema).select("id", "name", "ord")


ORACLES["stored_merge"] = """
    WITH old AS (SELECT c_custkey AS id, c_name AS name, c_custkey AS ord FROM customer WHERE c_custkey % 2 = 0),
    new AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 100 = 0 THEN '' ELSE lower(c_name) END AS name, c_custkey + 1000000 AS ord, 1 AS n FROM customer WHERE c_custkey % 50 = 0 UNION ALL SELECT c_custkey, c_name, c_custkey + 1000000, 2 FROM customer WHERE c_custkey % 51 = 1),
    every AS (SELECT *, 0 AS n FROM old UNION ALL SELECT * FROM new)
    SELECT id::BIGINT AS id, arg_max(name, (ord, n)) FILTER (name <> '') AS name, max(ord)::BIGINT AS ord FROM every WHERE id % 30 <> 0 GROUP BY id
"""

QUERIES = {f.__name__: f for f in (channel_diagnostics, recovery_queue, coverage_rollup, feed_name_index, verified_fixes, credits_load, reapplied_guide, stored_merge)}
