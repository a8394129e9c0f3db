"""Registered queries of identities, streams, similarity joins and whole jobs, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import timeparse
from tidemark.operators import lookup, people, running, similarity
from tidemark.plans import jobs
from tidemark.plans.oracles import _AT, _PROG
from tidemark.plans.queries import _now, _programmes
from tidemark.plans.store_queries import _table, _text
from tidemark.session import scratch
from tidemark.sources import xmltv
from tidemark.streaming import streams

ORACLES: dict[str, str] = {}


def _people(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Suppliers as stored people; customers in fives as arrivals of one person: by imdb id, by both ids, by tmdb id, in credits, and by both once more."""
    s, n = _table(spark, sf, "supplier"), F.col("s_suppkey").cast("long")
    none = F.lit(None).cast("bigint")
    stored = s.select(n.alias("person_id"), F.when(n % 2 == 0, n * 3).otherwise(none).alias("tmdb_id"), F.when(n % 3 == 0, _text("tt", n * 4)).otherwise("").alias("imdb_id"), _text("Stored ", n).alias("name"), F.lit("{}").alias("extra"))
    c, k = _table(spark, sf, "customer"), F.col("c_custkey").cast("long")
    q, r = F.floor(k / 5), k % 5
    tmdb = F.when(r.isin(1, 2, 4) | ((r == 3) & (q % 2 == 0)), q).otherwise(none)
    imdb = F.when(r.isin(0, 1), _text("tt", q)).when(r == 4, _text(" TT", F.when(q % 4 == 0, q + 1).otherwise(q))).otherwise("")
    name = F.when((r == 2) & (q % 3 == 0), "").when(r == 3, _text("PERSON ", F.floor(q / 7) * 7)).otherwise(_text("Person ", q))
    arrivals = c.select(k.alias("ord"), F.when(r == 3, "credits").otherwise("metadata").alias("path"), tmdb.alias("tmdb_id"), imdb.alias("imdb_id"), name.alias("name"), F.when(r == 1, _text('{"n":', k, "}")).otherwise("{}").alias("extra"))
    return stored, arrivals


def people_upsert(spark: SparkSession, sf: str) -> DataFrame:
    after, _ = people.upsert_people(*_people(spark, sf))
    return after.select("person_id", "tmdb_id", "imdb_id", "name", "extra")


def people_of_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    return people.upsert_people(*_people(spark, sf))[1]


_PEOPLE_SQL = """
    WITH RECURSIVE raw AS (
        SELECT s_suppkey::BIGINT AS node, s_suppkey::BIGINT AS person_id, 'stored' AS path, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey * 3 END AS tmdb, CASE WHEN s_suppkey % 3 = 0 THEN 'tt' || s_suppkey * 4 END AS imdb, 'Stored ' || s_suppkey AS name, NULL::VARCHAR AS extra
        FROM supplier
        UNION ALL
        SELECT 1000000000 + c_custkey, NULL, CASE WHEN r = 3 THEN 'credits' ELSE 'metadata' END, CASE WHEN r IN (1, 2, 4) OR r = 3 AND q % 2 = 0 THEN q END,
            CASE WHEN r IN (0, 1) THEN 'tt' || q WHEN r = 4 THEN 'tt' || CASE WHEN q % 4 = 0 THEN q + 1 ELSE q END END,
            CASE WHEN r = 2 AND q % 3 = 0 THEN NULL WHEN r = 3 THEN 'PERSON ' || q // 7 * 7 ELSE 'Person ' || q END, CASE WHEN r = 1 THEN '{"n":' || c_custkey || '}' END
        FROM (SELECT c_custkey, c_custkey // 5 AS q, c_custkey % 5 AS r FROM customer)
    ), keys AS (SELECT node, 'tmdb' || tmdb AS key FROM raw WHERE tmdb IS NOT NULL UNION SELECT node, imdb FROM raw WHERE imdb IS NOT NULL),
    reach AS (SELECT node, node AS label FROM raw UNION SELECT b.node, r.label FROM reach r JOIN keys a ON a.node = r.node JOIN keys b ON a.key = b.key),
    by_id AS (SELECT node, min(label) AS label FROM reach GROUP BY node),
    rows AS (SELECT raw.*, lower(name) AS norm, label, bool_and(path = 'credits') OVER (PARTITION BY label) AS loose FROM raw JOIN by_id USING (node)),
    owner AS (SELECT norm, min((loose, label))[2] AS owner FROM rows WHERE norm IS NOT NULL GROUP BY norm),
    links AS (SELECT label, owner FROM (SELECT label, arg_min(norm, node) AS norm FROM rows WHERE loose GROUP BY label) JOIN owner USING (norm)),
    near AS (SELECT label, owner AS key FROM links UNION SELECT owner, owner FROM links),
    reach2 AS (SELECT label AS node, label FROM near UNION SELECT b.label, r.label FROM reach2 r JOIN near a ON a.label = r.node JOIN near b ON a.key = b.key),
    named AS (SELECT node AS label, min(label) AS person FROM reach2 GROUP BY node),
    linked AS (SELECT rows.*, coalesce(person, label) AS person FROM rows LEFT JOIN named USING (label)),
    people AS (
        SELECT person, coalesce(min(person_id), (SELECT max(s_suppkey) FROM supplier) + 1 + min(node) FILTER (path <> 'stored') - 1000000000)::BIGINT AS person_id,
            coalesce(arg_max(tmdb, node) FILTER (tmdb IS NOT NULL AND path <> 'credits'), arg_min(tmdb, node) FILTER (tmdb IS NOT NULL))::BIGINT AS tmdb_id,
            coalesce(arg_max(imdb, node) FILTER (imdb IS NOT NULL), '') AS imdb_id, coalesce(arg_max(name, node) FILTER (name IS NOT NULL), '') AS name, coalesce(arg_max(extra, node) FILTER (extra IS NOT NULL), '{}') AS extra
        FROM linked GROUP BY person
    )
"""
ORACLES["people_upsert"] = f"{_PEOPLE_SQL} SELECT person_id, tmdb_id, imdb_id, name, extra FROM people"
ORACLES["people_of_arrivals"] = f"{_PEOPLE_SQL} SELECT node - 1000000000 AS ord, person_id FROM linked JOIN people USING (person) WHERE path <> 'stored'".replace("SELECT node - 1000000000 AS ord, person_id", "SELECT node - 1000000000 AS ord, people.person_id")


def _alias_runs(spark: SparkSession, sf: str) -> str:
    """Three runs of the alias stream, each from the last one's checkpoint; events are dealt so that later runs bring earlier ones."""
    path, check, landed = scratch(spark, "alias-changes"), scratch(spark, "alias-checkpoint"), scratch(spark, "alias-evidence")
    e = _table(spark, sf, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    evidence = e.select((micros * 1024 + F.col("event_id") % 1024).alias("ord"), F.col("user_id").cast("string").alias("alias"), F.lit("").alias("year"), F.when(F.col("event_id") % 2 == 0, "movie").otherwise("series").alias("media"), F.col("event_type").alias("identity"), F.col("value").cast("int").alias("confidence"), (F.col("value") > 50).cast("int").alias("verified"), _text("s", F.col("event_id") % 5).alias("source"), (F.col("event_id") % 3).alias("run"))
    for run in range(3):
        evidence.where(F.col("run") == run).drop("run").write.mode("append").parquet(landed)
        streams.learn_aliases(spark.readStream.schema(streams.EVIDENCE).parquet(landed), path, check).awaitTermination()
    return path


def alias_stream_runs(spark: SparkSession, sf: str) -> DataFrame:
    return streams.current_aliases(spark, _alias_runs(spark, sf)).select("alias", "media", "identity", "evidence_count", "confidence", "verified", "source")


def alias_stream_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return streams.alias_conflicts(spark, _alias_runs(spark, sf)).groupBy("alias", "media", "known_identity", "identity").agg(F.count("*").alias("n"))


_ALIAS_SQL = """
    WITH e AS (SELECT user_id::VARCHAR AS alias, CASE WHEN event_id % 2 = 0 THEN 'movie' ELSE 'series' END AS media, event_type AS identity, trunc(value)::INT AS confidence, (value > 50)::INT AS verified, 's' || event_id % 5 AS source, (event_id % 3, ts, event_id) AS came FROM events),
    f AS (SELECT alias, media, arg_min(identity, came) AS known FROM e GROUP BY 1, 2)
"""
ORACLES["alias_stream_runs"] = f"{_ALIAS_SQL} SELECT alias, media, identity, count(*) AS evidence_count, max(confidence) AS confidence, max(verified) AS verified, arg_max(source, came) AS source FROM e JOIN f USING (alias, media) WHERE identity = known GROUP BY ALL"
ORACLES["alias_stream_conflicts"] = f"{_ALIAS_SQL} SELECT alias, media, known AS known_identity, identity, count(*) AS n FROM e JOIN f USING (alias, media) WHERE identity <> known GROUP BY ALL"


def guide_passthrough(spark: SparkSession, sf: str) -> DataFrame:
    """Programmes with a child that nobody knows: written, read by their first bytes, moved by an hour, written and read again."""
    p = _programmes(spark, sf).where("stop IS NOT NULL")
    raw = F.concat(F.lit('<programme start="'), "start", F.lit('" stop="'), "stop", F.lit('" channel="u'), "channel", F.lit('"><title>'), "title", F.lit("</title><odd n='"), F.col("ord").cast("string"), F.lit("'/></programme>"))
    shown = p.select(F.concat(F.lit("u"), "channel").alias("channel"), "start", "stop", "title", F.lit("").alias("desc"), F.array().cast("array<string>").alias("categories"), raw.alias("raw"))
    channels = shown.select(F.col("channel").alias("output_tvg_id"), F.array("channel").alias("display_names")).distinct()
    once, twice = scratch(spark, "guide"), scratch(spark, "guide")
    xmltv.write_guide(channels, shown, once)
    read = xmltv.read_elements(spark, once)
    later = xmltv.retimed(xmltv.programmes_of(read, F.lit(0)), timeparse.shift(F.col("start"), F.lit(60)), timeparse.shift(F.col("stop"), F.lit(60)))
    xmltv.write_guide(xmltv.channels_of(read, F.lit(0)).select(F.col("id").alias("output_tvg_id"), "display_names", "raw"), later, twice)
    back = xmltv.programmes_of(xmltv.read_elements(spark, twice), F.lit(0))
    odd = F.regexp_extract("raw", r"<odd n=.(\d+)", 1).cast("bigint")
    return back.groupBy("channel").agg(F.count("*").alias("n"), F.min("start").alias("first"), F.max("stop").alias("last"), F.sum(odd).alias("odd"), F.max("title").alias("title"))


ORACLES["guide_passthrough"] = f"""
    WITH {_PROG}, t AS (SELECT *, strftime(start_at + INTERVAL 1 HOUR, '%Y%m%d%H%M%S') || ' +0000' AS a, strftime(stop_at + INTERVAL 1 HOUR, '%Y%m%d%H%M%S') || ' +0000' AS b FROM secs WHERE stop_at IS NOT NULL)
    SELECT 'u' || channel AS channel, count(*) AS n, min(a) AS first, max(b) AS last, sum(event_id)::BIGINT AS odd, max(title) AS title FROM t GROUP BY 1
"""


def _searched(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Part names as titles to search for, in six kinds: as they are, with a subtitle or number, in parts, unknown, misspelt, and of entries without an imdb id."""
    p = _table(spark, sf, "part").withColumn("name", F.concat_ws(" ", "p_name", "p_type"))
    k = F.col("p_partkey")
    kind, none = k % 6, F.lit(None).cast("array<string>")
    title = F.when(kind == 1, F.concat("name", F.when(k % 4 < 2, ". Part").otherwise(". 3"))).when(kind == 3, F.concat(F.lit("zzzz qqqq jjjj"), F.col("p_size").cast("string"), F.lit(". "), "name")).when(kind == 4, F.concat(F.substr("name", F.lit(1), F.length("name") - 1), F.lit("q"))).otherwise(F.col("name"))
    raw = F.when(kind.isin(2, 3), F.concat(title, F.lit(", 2 с"))).otherwise(title)
    wanted = p.select(k.cast("bigint").alias("query_id"), title.alias("title"), raw.alias("raw"), F.when(k % 5 < 2, "2001").otherwise("").alias("year"), F.when(kind.isin(1, 3), "series").otherwise("movie").alias("media"), F.lit("en-US").alias("language"), none.alias("hints"), (k % 4).alias("priority"))
    c, n = p.groupBy("name").agg(F.min("p_partkey").alias("id")), F.col("id")
    catalogue = c.select("id", n.alias("pos"), F.col("name").alias("title"), F.lit("").alias("original_title"), F.when(n % 5 == 0, "2001").when(n % 5 == 1, "1990").otherwise("").alias("year"), F.when(n % 3 == 0, "series").otherwise("movie").alias("media"), F.when(n % 4 == 0, "").otherwise(_text("TT", n + 1_000_000)).alias("imdb_id"))
    return wanted, catalogue


def title_search(spark: SparkSession, sf: str) -> DataFrame:
    wanted, catalogue = _searched(spark, sf)
    return lookup.search(wanted, catalogue, similarity.EDITS).select("query_id", "status", "attempts", "requests", "id", "imdb_id", "label", "query", F.round("similarity", 6).alias("similarity"), "confidence")


def title_search_within(spark: SparkSession, sf: str) -> DataFrame:
    wanted, catalogue = _searched(spark, sf)
    return lookup.search_within(wanted, catalogue, ["priority"], 1300, 3000, similarity.EDITS).select("query_id", "status", "attempts", "requests", "id")


_SEARCH_SQL = """
    WITH n AS (SELECT p_partkey AS k, p_size, p_name || ' ' || p_type AS name FROM part),
    w AS (
        SELECT k, CASE k % 6 WHEN 1 THEN name || CASE WHEN k % 4 < 2 THEN '. Part' ELSE '. 3' END WHEN 3 THEN 'zzzz qqqq jjjj' || p_size || '. ' || name WHEN 4 THEN name[1:length(name) - 1] || 'q' ELSE name END AS title,
            CASE WHEN k % 5 < 2 THEN '2001' ELSE '' END AS year, CASE WHEN k % 6 IN (1, 3) THEN 'series' ELSE 'movie' END AS media, k % 6 IN (2, 3) AS parts
        FROM n
    ), c AS (
        SELECT min(k) AS id, name, CASE min(k) % 5 WHEN 0 THEN '2001' WHEN 1 THEN '1990' ELSE '' END AS c_year, CASE WHEN min(k) % 3 = 0 THEN 'series' ELSE 'movie' END AS c_media, CASE WHEN min(k) % 4 = 0 THEN '' ELSE 'tt' || min(k) + 1000000 END AS imdb_id
        FROM n GROUP BY name
    ), steps AS (
        SELECT k, 0 AS pos, title AS q, year AS y, media AS m, 'localized+year' AS label FROM w UNION ALL SELECT k, 1, title, '', media, 'localized-no-year' FROM w WHERE year <> ''
        UNION ALL SELECT k, 2, split_part(title, '. ', 1), year, 'series', 'series-root+year' FROM w WHERE media = 'series' UNION ALL SELECT k, 3, split_part(title, '. ', 1), '', 'series', 'series-root-no-year' FROM w WHERE media = 'series' AND year <> ''
        UNION ALL SELECT k, 4, title, year, CASE media WHEN 'movie' THEN 'series' ELSE 'movie' END, 'cross-type+year' FROM w WHERE parts UNION ALL SELECT k, 5, title, '', CASE media WHEN 'movie' THEN 'series' ELSE 'movie' END, 'cross-type-no-year' FROM w WHERE parts AND year <> ''
    ), asked AS (SELECT DISTINCT q, y, m FROM steps),
    scored AS (SELECT *, CASE WHEN q = name THEN 1.0 ELSE 1 - levenshtein(q, name) / greatest(length(q), length(name))::DOUBLE END AS sim, y <> '' AND c_year <> '' AND abs(try_cast(y AS INT) - try_cast(c_year AS INT)) <= 1 AS fits FROM asked JOIN c ON m = c_media),
    best AS (SELECT * FROM scored WHERE sim >= 0.82 AND (y = '' OR c_year = '' OR fits) QUALIFY row_number() OVER (PARTITION BY q, y, m ORDER BY sim + CASE WHEN fits THEN 0.08 ELSE 0 END DESC, id) = 1),
    plan AS (SELECT k, row_number() OVER (PARTITION BY k ORDER BY pos) AS pos, s.q, label, id, imdb_id, sim, fits, lower(s.q) = lower(name) AS exact, coalesce(imdb_id <> '', false) AS hit FROM steps s LEFT JOIN best b ON s.q = b.q AND s.y = b.y AND s.m = b.m),
    island AS (SELECT *, count(id) OVER (PARTITION BY k ORDER BY pos) AS finds FROM plan),
    ending AS (SELECT *, hit OR sum((id IS NULL)::INT) OVER (PARTITION BY k, finds ORDER BY pos) >= 4 AS ends FROM island),
    made AS (SELECT * FROM ending QUALIFY NOT coalesce(bool_or(ends) OVER (PARTITION BY k ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false)),
    one AS (SELECT k, count(*) AS attempts, count(*) + count(id) AS requests, arg_min((q, label, id, imdb_id, sim, fits, exact), (NOT hit, pos)) FILTER (id IS NOT NULL) AS x FROM made GROUP BY k),
    found AS (
        SELECT k AS query_id, CASE WHEN x IS NULL THEN 'not_found' WHEN x[4] = '' THEN 'no_imdb_id' WHEN x[2] LIKE 'series-root%' AND title NOT LIKE '%. 3' THEN 'unverified' ELSE 'found' END AS status, attempts, requests, x[3] AS id, x[4] AS imdb_id, x[2] AS label, x[1] AS query, x[5]::DOUBLE AS similarity,
            (CASE WHEN x[7] AND x[6] THEN 100 WHEN x[7] THEN 98 WHEN x[5] >= 0.95 AND x[6] THEN 97 WHEN x[5] >= 0.95 THEN 95 WHEN x[5] >= 0.9 THEN 92 WHEN x[5] >= 0.84 THEN 88 WHEN x IS NULL THEN NULL ELSE 84 END - CASE WHEN x[2] LIKE 'cross%' THEN 3 ELSE 0 END)::INT AS confidence
        FROM one JOIN w USING (k)
    )
"""
ORACLES["title_search"] = f"{_SEARCH_SQL} SELECT query_id, status, attempts, requests, id, imdb_id, label, query, round(similarity, 6) AS similarity, confidence FROM found"
ORACLES["title_search_within"] = f"""{_SEARCH_SQL}, spent AS (
        SELECT *, row_number() OVER w - 1 AS titles, coalesce(sum(requests) OVER (ORDER BY query_id % 4, query_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS so_far FROM found WINDOW w AS (ORDER BY query_id % 4, query_id)
    ), said AS (SELECT *, CASE WHEN titles >= 1300 OR so_far >= 3000 THEN 'not_attempted' WHEN so_far + requests > 3000 THEN 'budget_exhausted' ELSE status END AS outcome FROM spent)
    SELECT query_id, outcome AS status, CASE WHEN outcome = status THEN attempts END AS attempts, CASE WHEN outcome = status THEN requests END AS requests, CASE WHEN outcome = status THEN id END AS id FROM said
"""


def running_budget(spark: SparkSession, sf: str) -> DataFrame:
    """Line items in the order of their orders: what was spent before each, and where two budgets end."""
    li = _table(spark, sf, "lineitem").select(F.col("l_shipdate").alias("day"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(F.col("l_linenumber") != 5, F.col("l_quantity").cast("bigint")).alias("cost"))
    order = ["day", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    sums = running.running_sums(li, order, {"rows": F.lit(1), "spent": F.col("cost")})
    cut = running.within_budgets(sums, order, F.col("cost"), 20_000, 300_000)
    return cut.groupBy(F.date_format("day", "yyyy-MM-dd").alias("day"), F.col("spent").alias("state")).agg(F.count("*").alias("n"), F.min("rows").alias("rows"), F.sum("cost").alias("cost"))


ORACLES["running_budget"] = """
    WITH c AS (SELECT l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber <> 5 THEN trunc(l_quantity)::BIGINT END AS cost FROM lineitem),
    r AS (SELECT *, row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS rows, coalesce(sum(cost) OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM c)
    SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, CASE WHEN rows >= 20000 OR before >= 300000 THEN 'not_attempted' WHEN before + coalesce(cost, 0) <= 300000 THEN 'done' ELSE 'exhausted' END AS state, count(*) AS n, min(rows) AS rows, sum(cost)::BIGINT AS cost FROM r GROUP BY 1, 2
"""


_ENTITY = "imdb_id string, title string, year string, rating string, votes string, overview string, poster string, backdrop string, genre_ids array<int>, genres array<string>"


def _store_and_schedule(spark: SparkSession, sf: str) -> tuple[DataFrame, ...]:
    """Part names as a schedule of ten kinds, a store that knows a third of them, and a catalogue of all."""
    p = _table(spark, sf, "part").withColumn("name", F.concat_ws(" ", "p_name", "p_type"))
    k = F.col("p_partkey").cast("bigint")
    kinds = ["", F.concat(F.lit("х/ф "), "name"), "В приближении: кино", "д/ф Море", F.concat(F.lit("х/ф "), "name"), F.concat(F.lit("т/с "), "name", F.lit(" (Episode "), (k % 97).cast("string"), F.lit(")")), F.concat(F.lit("х/ф "), "name", F.lit(" 2 с")), "х/ф П'ятий елемент", "ab", F.col("name")]
    title = F.element_at(F.array(*[F.lit(x) if isinstance(x, str) else x for x in kinds]), (k % 10 + 1).cast("int"))
    none = F.array().cast("array<string>")
    programmes = p.select(
        k.alias("ord"), _text("c", k % 20).alias("channel"), title.alias("title"), F.when(k % 10 == 1, "IMDb 7.5 tt0000001").otherwise("").alias("desc"), F.lit("").alias("lang"), F.when(k % 10 == 8, F.array(F.lit("movie"))).otherwise(none).alias("categories"), F.lit(False).alias("has_episode"),
        F.lit("").alias("date"), F.lit(None).cast("array<struct<system:string,value:string>>").alias("rating"), F.lit(None).cast("array<string>").alias("url"), F.lit("").alias("icon"),
    )
    groups = programmes.select(F.col("channel").alias("output_tvg_id")).distinct().where("output_tvg_id <> 'c19'").withColumn("grp", F.lit(""))
    names, n = p.groupBy("name").agg(F.min("p_partkey").cast("bigint").alias("id")), F.col("id")
    imdb = _text("tt", n + 1_000_000)
    titles = names.where(n % 3 == 0).select(n.alias("title_id"), F.lower("name").alias("norm"), F.lit("").alias("year"), F.when(n % 2 == 1, "movie").otherwise("series").alias("media"), imdb.alias("imdb_id"))
    blank = F.lit("")
    entity = lambda rating, overview, year: [imdb.alias("imdb_id"), F.col("name").alias("title"), year.alias("year"), rating.alias("rating"), F.lit("10").alias("votes"), overview.alias("overview"), blank.alias("poster"), blank.alias("backdrop"), F.array(F.lit(18)).alias("genre_ids"), none.alias("genres")]
    entities = names.select(*entity(F.when(n % 7 == 0, "").otherwise("6.5"), F.when(n % 2 == 0, "Overview").otherwise(""), F.when(n % 5 == 0, "2001").otherwise("")))
    seeds = names.where(n % 3 == 0).select(*entity(F.lit("7.0"), F.when(n % 4 == 1, "Seed").otherwise(""), blank))
    both = names.withColumn("media", F.explode(F.array(F.lit("movie"), F.lit("series"))))
    catalogue = both.select((n * 2 + (F.col("media") == "series").cast("int")).alias("id"), n.alias("pos"), F.col("name").alias("title"), blank.alias("original_title"), blank.alias("year"), "media", F.when(n % 4 == 0, "").otherwise(imdb).alias("imdb_id"))
    aliases = titles.select(F.col("norm").alias("alias"), "year", "media", "title_id", F.lit(99).alias("confidence")).limit(0)
    return programmes, groups, aliases, titles, entities, seeds, catalogue


def _enriched(spark: SparkSession, sf: str) -> jobs.Enrichment:
    programmes, groups, *held = _store_and_schedule(spark, sf)
    return jobs.enrichment_run(programmes, groups, [], *held, scratch(spark, "enriched"), 100, 150, similarity.EDITS)


def enrichment_funnel(spark: SparkSession, sf: str) -> DataFrame:
    """The counters of an enrichment run, as they were counted while it wrote its guide."""
    return spark.createDataFrame(list(_enriched(spark, sf).counters.items()), "counter string, n bigint")


def enrichment_guide(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(_enriched(spark, sf).path).select("ord", "title", "outcome", "desc", "genre")


def enrichment_report(spark: SparkSession, sf: str) -> DataFrame:
    return _enriched(spark, sf).report.select("ord", "title", "media", "status", "origin", "imdb_id")


_ENRICH_SQL = """
    WITH n AS (SELECT p_partkey AS k, p_name || ' ' || p_type AS name FROM part), ids AS (SELECT name, min(k) AS id FROM n GROUP BY 1),
    p AS (
        SELECT k, id, name, k % 10 AS kind, 'c' || k % 20 AS channel, CASE k % 10 WHEN 4 THEN 'movie' WHEN 5 THEN 'series' WHEN 6 THEN 'series' END AS media, CASE WHEN k % 10 = 5 THEN 2 ELSE 1 END AS priority,
            CASE k % 10 WHEN 0 THEN 'untitled' WHEN 1 THEN 'existing' WHEN 2 THEN 'generic' WHEN 3 THEN 'non_fiction' WHEN 7 THEN 'language' WHEN 8 THEN 'short' WHEN 9 THEN 'non_fiction' ELSE 'wanted' END AS outcome,
            CASE k % 10 WHEN 0 THEN '' WHEN 1 THEN 'х/ф ' || name WHEN 2 THEN 'В приближении: кино' WHEN 3 THEN 'д/ф Море' WHEN 4 THEN 'х/ф ' || name WHEN 5 THEN 'т/с ' || name || ' (Episode ' || k % 97 || ')' WHEN 6 THEN 'х/ф ' || name || ' 2 с' WHEN 7 THEN 'х/ф П''ятий елемент' WHEN 8 THEN 'ab' ELSE name END AS title
        FROM n JOIN ids USING (name) WHERE k % 20 <> 19
    ), keys AS (SELECT name, media, any_value(id) AS id, arg_min(k, (priority, channel, k)) AS first, arg_min(kind, (priority, channel, k)) AS kind, arg_min(priority, (priority, channel, k)) AS priority, arg_min(channel, (priority, channel, k)) AS channel FROM p WHERE outcome = 'wanted' GROUP BY 1, 2),
    asked AS (SELECT *, id % 3 = 0 AND media = CASE WHEN id % 2 = 1 THEN 'movie' ELSE 'series' END AS known, CASE WHEN id % 4 <> 0 THEN 2 WHEN kind = 6 THEN 4 ELSE 2 END AS requests FROM keys),
    spent AS (SELECT *, row_number() OVER w - 1 AS titles, coalesce(sum(requests) OVER (ORDER BY priority, channel, first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS so_far FROM asked WHERE NOT known WINDOW w AS (ORDER BY priority, channel, first)),
    entries AS (
        SELECT name, media, first, 'knowledge' AS origin, 'found' AS status FROM asked WHERE known
        UNION ALL SELECT name, media, first, 'search', CASE WHEN titles >= 100 OR so_far >= 150 THEN 'not_attempted' WHEN so_far + requests > 150 THEN 'budget_exhausted' WHEN id % 4 = 0 THEN 'no_imdb_id' ELSE 'found' END FROM spent
    ), r AS (
        SELECT p.*, origin, status, first, coalesce(k = first, false) AS is_first, coalesce(status = 'found', false) AS resolved, outcome = 'existing' OR coalesce(status = 'found', false) AS shown,
            CASE WHEN outcome = 'existing' THEN '7.5' WHEN id % 3 = 0 THEN '7.0' WHEN id % 7 = 0 THEN '' ELSE '6.5' END AS rating, CASE WHEN outcome = 'existing' THEN '' WHEN id % 2 = 0 THEN 'Overview' WHEN id % 3 = 0 AND id % 4 = 1 THEN 'Seed' ELSE '' END AS overview,
            CASE WHEN id % 5 = 0 AND outcome <> 'existing' THEN ' (2001)' ELSE '' END AS year
        FROM p LEFT JOIN entries USING (name, media)
    )
"""
_COUNTERS = {
    "programmes_considered": "true", "programmes_with_existing_imdb": "outcome = 'existing'", "generic_schedule_blocks_skipped": "outcome = 'generic'", "non_fiction_skipped": "outcome = 'non_fiction'", "not_movie_or_series": "false", "title_too_short": "outcome = 'short'",
    "non_ru_en_titles_skipped": "outcome = 'language'", "uk_titles_skipped": "outcome = 'language'", "episode_titles_collapsed": "kind = 5", "multipart_movies_reclassified": "kind = 6", "in_run_memo_hits": "outcome = 'wanted' AND NOT is_first", "knowledge_hits": "is_first AND origin = 'knowledge'",
    **{f"lookup_{x}": f"is_first AND origin = 'search' AND status = '{x}'" for x in ("found", "unverified", "no_imdb_id", "not_found", "budget_exhausted", "not_attempted")},
    "programmes_enriched": "shown", "programmes_with_rating": "shown AND rating <> ''", "programmes_with_overview": "shown AND overview <> ''",
}
ORACLES["enrichment_funnel"] = f"{_ENRICH_SQL} " + " UNION ALL ".join(f"SELECT '{name}' AS counter, count(*) FILTER ({test}) AS n FROM r" for name, test in _COUNTERS.items())
ORACLES["enrichment_guide"] = f"""{_ENRICH_SQL} SELECT k AS ord, CASE WHEN shown THEN name || year || CASE WHEN rating <> '' THEN ' · IMDb ' || rating ELSE '' END ELSE title END AS title, outcome,
    CASE WHEN shown AND outcome = 'wanted' THEN overview WHEN outcome = 'existing' THEN 'IMDb 7.5 tt0000001' ELSE '' END AS desc, CASE WHEN outcome = 'existing' THEN '' WHEN shown THEN 'драма' END AS genre FROM r"""
ORACLES["enrichment_report"] = f"{_ENRICH_SQL} SELECT e.first AS ord, e.name AS title, e.media, status, origin, CASE WHEN status = 'found' THEN 'tt' || id + 1000000 END AS imdb_id FROM entries e JOIN ids USING (name)"


def _build_inputs(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Customers as channels of four kinds (by id, by family in the second pass, of another country, by name); users as the ids of two feeds, one of them Romanian."""
    k = F.col("c_custkey")
    n, kind = (k % 200).cast("string"), k % 4
    name = F.when(kind == 0, _text("Plain ", k)).when(kind == 3, _text("Named ", n)).otherwise(_text("Discovery ", n, " RO"))
    channels = _table(spark, sf, "customer").select(
        k.cast("bigint").alias("channel_index"), name.alias("name"), F.when(kind == 0, _text("u", n)).when(kind == 3, _text("no_epg_", k)).otherwise("").alias("tvg_id"), F.lit("").alias("tvg_name"),
        F.when(kind == 1, "Румыния").when(kind == 2, "Италия").otherwise(_text("G", k % 3)).alias("grp"), _text("http://example.test/", k).alias("url"),
    )
    feeds = spark.createDataFrame([(0, "feed0", [], [], False), (1, "feed1", [], ["RO"], False)], "source_index int, name string, groups array<string>, regions array<string>, require_region_for_id boolean")
    p = _programmes(spark, sf)
    u = F.col("channel").cast("int")
    own = p.select("channel", F.lit(0).alias("source_index"), _text("u", F.col("channel")).alias("id"), F.array(_text("Nobody ", F.col("channel"))).alias("display_names"))
    romanian = p.where(u % 3 != 0).select("channel", F.lit(1).alias("source_index"), _text("r", F.col("channel")).alias("id"), F.array(_text("Discovery ", F.col("channel")), _text("Named ", F.col("channel"))).alias("display_names"))
    feed_channels = own.unionByName(romanian).drop("channel").distinct()
    programmes = p.select(F.explode(F.array(F.struct(F.lit(0).alias("source_index"), _text("u", F.col("channel")).alias("id")), F.struct(F.lit(1).alias("source_index"), _text("r", F.col("channel")).alias("id")))).alias("x"), "start", "stop", "title").select("x.source_index", F.col("x.id").alias("channel"), "start", "stop", "title")
    programmes = programmes.join(feed_channels.select("source_index", F.col("id").alias("channel")), ["source_index", "channel"])
    empty = lambda s: spark.createDataFrame([], s)
    overrides = channels.where("channel_index % 100 = 3").select(F.col("name").alias("playlist_name")).distinct().select("playlist_name", F.lit("*").alias("source_id"), F.lit("wrong").alias("status"), F.lit("heard").alias("reason"), F.lit("").alias("evidence_url"))
    return {
        "channels": channels, "feeds": feeds, "feed_channels": feed_channels, "programmes": programmes, "aliases": empty("ord bigint, name string, source string, grp string, region string, target_id string, hard_pin string"),
        "id_fixes": empty("enabled string, playlist_name string, new_tvg_id string, ord bigint"), "offsets": empty("source string, source_id string, offset_minutes int"), "overrides": overrides, "now": _now(),
    }


def guide_mapping(spark: SparkSession, sf: str) -> DataFrame:
    """The mapping that a build publishes, both passes, without what was quarantined or brings no usable programme."""
    made = jobs.build_guide(**_build_inputs(spark, sf))
    return made.mapping.select("channel_index", "output_tvg_id", "source", "method", "confidence", "pass", "programmes", "usable")


def _built(spark: SparkSession, sf: str) -> tuple[jobs.Build, str]:
    """Two runs of a build: the second playlist has other channels, and some at other addresses."""
    given, folder = _build_inputs(spark, sf), scratch(spark, "build")
    channels, k = given.pop("channels"), F.col("channel_index")
    jobs.build_run(channels.where(k % 5 != 0), **given, folder=folder, run_id="2024-01-14")
    url = F.when(k % 11 == 0, F.concat("url", F.lit("b"))).otherwise(F.col("url"))
    return jobs.build_run(channels.where(k % 7 != 0).withColumn("url", url), **given, folder=folder, run_id="2024-01-15"), folder


def build_status(spark: SparkSession, sf: str) -> DataFrame:
    """The second run's counts, what changed in the playlist, what each source brought over both runs, and what the published guide holds."""
    made, folder = _built(spark, sf)
    counts = made.status.select(F.explode(F.create_map(*[x for c in ("channels", "matched", "unresolved", "programmes") for x in (F.lit(c), F.col(c))])).alias("name", "n"))
    changes = made.changes.groupBy(F.concat(F.lit("changed: "), "change").alias("name")).agg(F.count("*").alias("n"))
    ranking = made.ranking.select(F.concat(F.lit("added: "), "source").alias("name"), F.col("total_added").cast("bigint").alias("n"))
    elements = xmltv.read_elements(spark, f"{folder}/guide.xml.gz").groupBy(F.concat(F.lit("guide: "), "kind").alias("name")).agg(F.count("*").alias("n"))
    return counts.unionByName(changes).unionByName(ranking).unionByName(elements)


_BUILD_SQL = f"""
    WITH {_PROG}, kept AS (SELECT channel AS u, (stop_at IS NULL OR stop_at >= {_AT} - INTERVAL 6 HOUR) AND start_at <= {_AT} + INTERVAL 48 HOUR AS usable FROM secs WHERE start_at::DATE BETWEEN DATE '2024-01-10' AND DATE '2024-02-05'),
    live AS (SELECT u, count(*) AS programmes, count(*) FILTER (usable) AS usable FROM kept GROUP BY 1),
    c AS (
        SELECT c_custkey AS k, (c_custkey % 200)::VARCHAR AS n, c_custkey % 4 AS kind, CASE c_custkey % 4 WHEN 0 THEN 'Plain ' || c_custkey WHEN 3 THEN 'Named ' || c_custkey % 200 ELSE 'Discovery ' || c_custkey % 200 || ' RO' END AS name,
            CASE c_custkey % 4 WHEN 0 THEN 'u' || c_custkey % 200 WHEN 3 THEN 'no_epg_' || c_custkey ELSE '' END AS tvg_id FROM customer
    ), m AS (
        SELECT k, name, CASE WHEN kind = 0 THEN 'u' ELSE 'r' END || n AS output_tvg_id, CASE WHEN kind = 0 THEN 'feed0' ELSE 'feed1' END AS source, CASE kind WHEN 0 THEN 'id' WHEN 1 THEN 'family-region' ELSE 'name' END AS method, CASE kind WHEN 0 THEN 99 WHEN 1 THEN 92 ELSE 90 END::INT AS confidence, CASE WHEN kind = 1 THEN 2 ELSE 1 END::INT AS pass, programmes, usable
        FROM c JOIN live ON n = u WHERE usable > 0 AND (kind = 0 OR kind IN (1, 3) AND n::INT % 3 <> 0)
    )
"""
ORACLES["guide_mapping"] = f"{_BUILD_SQL} SELECT k AS channel_index, output_tvg_id, source, method, confidence, pass, programmes, usable FROM m WHERE name NOT IN (SELECT name FROM c WHERE k % 100 = 3)"
ORACLES["build_status"] = f"""{_BUILD_SQL}, all2 AS (SELECT * FROM m WHERE k % 7 <> 0), valid2 AS (SELECT * FROM all2 WHERE name NOT IN (SELECT name FROM c WHERE k % 100 = 3)), valid1 AS (SELECT * FROM m WHERE k % 5 <> 0 AND name NOT IN (SELECT name FROM c WHERE k % 100 = 3)),
    s AS (SELECT k, CASE WHEN tvg_id <> '' THEN tvg_id ELSE name END AS key, name, CASE kind WHEN 1 THEN 'Румыния' WHEN 2 THEN 'Италия' ELSE 'G' || k % 3 END AS grp, 'http://example.test/' || k AS url FROM c),
    a AS (SELECT key, arg_max((name, grp, url), k) AS x FROM s WHERE k % 5 <> 0 GROUP BY 1), b AS (SELECT key, arg_max((name, grp, url || CASE WHEN k % 11 = 0 THEN 'b' ELSE '' END), k) AS y FROM s WHERE k % 7 <> 0 GROUP BY 1),
    d AS (SELECT unnest([CASE WHEN x IS NULL THEN 'added' END, CASE WHEN y IS NULL THEN 'removed' END, CASE WHEN x[1] <> y[1] THEN 'renamed' END, CASE WHEN x[2] <> y[2] THEN 'group' END, CASE WHEN x[3] <> y[3] THEN 'url' END]) AS change FROM a FULL JOIN b USING (key)),
    g AS (SELECT DISTINCT output_tvg_id, programmes FROM all2), t AS (SELECT count(*) FROM s WHERE k % 7 <> 0)
    SELECT 'channels' AS name, (FROM t) AS n UNION ALL SELECT 'matched', count(*) FROM valid2 UNION ALL SELECT 'unresolved', (FROM t) - count(*) FROM valid2 UNION ALL SELECT 'programmes', sum(programmes)::BIGINT FROM g
    UNION ALL SELECT 'changed: ' || change, count(*) FROM d WHERE change IS NOT NULL GROUP BY 1 UNION ALL SELECT 'added: ' || source, count(*) FROM (SELECT source FROM valid1 UNION ALL SELECT source FROM valid2) GROUP BY 1
    UNION ALL SELECT 'guide: channel', count(*) FROM g UNION ALL SELECT 'guide: programme', sum(programmes)::BIGINT FROM g
"""

QUERIES = {f.__name__: f for f in (people_upsert, people_of_arrivals, alias_stream_runs, alias_stream_conflicts, guide_passthrough, title_search, title_search_within, running_budget, enrichment_funnel, enrichment_guide, enrichment_report, guide_mapping, build_status)}
