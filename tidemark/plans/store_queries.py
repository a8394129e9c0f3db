"""Registered queries of the store's lookups and merges and of value tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import titles
from tidemark.operators import common, store


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _text(*parts) -> F.Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def entity_ratings(spark: SparkSession, sf: str) -> DataFrame:
    p, k = _table(spark, sf, "part"), F.col("p_partkey")
    as_of = F.lit("2024-01-31").cast("timestamp_ntz")
    wanted = p.select(_text("tt", k).alias("imdb_id"))
    cached = p.where(k % 2 == 0).select(_text("tt", k).alias("imdb_id"), F.when(k % 3 == 0, "").otherwise("7").alias("rating"), F.col("p_size").cast("long").alias("votes"), (as_of - F.make_dt_interval(days=F.col("p_size").cast("int"))).alias("checked_at"))
    ratings = p.where(k % 3 != 1).select(_text("tt", k).alias("tconst"), (F.col("p_size") % 10).cast("string").alias("averageRating"), k.cast("long").alias("numVotes"))
    return store.entity_rating(wanted, cached, ratings, as_of).select("imdb_id", "rating", "votes", F.date_format("checked_at", "yyyyMMdd").alias("checked"))


def identity_lookup(spark: SparkSession, sf: str) -> DataFrame:
    c, k = _table(spark, sf, "customer"), F.col("c_custkey")
    s, n = _table(spark, sf, "supplier"), F.col("s_suppkey")
    wanted = c.select(k.alias("query_id"), F.when(k % 3 == 0, _text("tt", k % 50)).otherwise("").alias("imdb_id"), F.when(k % 3 == 1, (k % 40).cast("string")).otherwise("").alias("tmdb_id"), F.when(k % 2 == 0, "movie").otherwise("series").alias("media"), _text("name ", F.col("c_nationkey")).alias("norm"), (1990 + k % 4).cast("string").alias("year"))
    held = s.select(n.alias("title_id"), _text("tt", n % 60).alias("imdb_id"), (n % 30).cast("string").alias("tmdb_id"), F.when(n % 2 == 0, "movie").otherwise("series").alias("media"), _text("name ", F.col("s_nationkey")).alias("norm"), (1990 + n % 4).cast("string").alias("year"))
    return store.find_identity(wanted, held).select("query_id", "title_id")


def alias_by_year(spark: SparkSession, sf: str) -> DataFrame:
    p, k = _table(spark, sf, "part"), F.col("p_partkey")
    wanted = p.select(F.col("p_name").alias("alias"), F.when(k % 3 == 0, "2000").when(k % 3 == 1, "1999").otherwise("").alias("year"), F.lit("movie").alias("media"), k.alias("k"))
    aliases = p.groupBy(F.col("p_name").alias("alias"), F.when(F.col("p_size") % 2 == 0, "2000").otherwise("").alias("year"), F.lit("movie").alias("media")).agg(F.min("p_partkey").alias("title_id"))
    return store.alias_lookup(wanted, aliases).select("k", F.col("found.title_id").alias("title_id"))


def keyed_lookup(spark: SparkSession, sf: str) -> DataFrame:
    wanted = _table(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") * 2).alias("c_custkey"))
    held = _table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    return store.lookup(wanted, held, ["c_custkey"]).select("o_orderkey", F.col("row.c_name").alias("name"), F.col("row.c_nationkey").alias("nation"))


def store_counts(spark: SparkSession, sf: str) -> DataFrame:
    return store.table_counts({n: _table(spark, sf, n) for n in ("region", "nation", "customer", "supplier", "lineitem")})


def statistics_merge(spark: SparkSession, sf: str) -> DataFrame:
    e = _table(spark, sf, "events").select(F.col("event_id").alias("ord"), _text(F.col("event_type"), "/", F.col("user_id")).alias("key"), F.col("value").cast("string").alias("value"))
    return store.statistics(e.where("ord % 3 = 0"), e.where("ord % 3 <> 0")).select("key", "ord")


def credits_merge(spark: SparkSession, sf: str) -> DataFrame:
    li, s = _table(spark, sf, "lineitem"), F.col("l_suppkey")
    ord_ = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long")
    people = li.select((F.col("l_orderkey") % 100).alias("title_id"), F.when(s % 2 == 0, s).alias("tmdb_id"), F.when(s % 3 == 0, _text("nm", s)).otherwise("").alias("imdb_id"), F.lit("zed").alias("name"), F.when(F.col("l_linenumber") % 2 == 0, "actor").otherwise("director").alias("role"), F.lit("").alias("character"), F.lit("").alias("job"), F.when(F.col("l_linenumber") % 3 != 0, F.col("l_linenumber")).cast("int").alias("billing"), ord_.alias("ord"))
    keyed = store.people_keys(people).select("title_id", "person_key", "role", "character", "job", "billing", "ord")
    return store.merge_credits(keyed.where("ord % 4 <> 0"), keyed.where("ord % 4 = 0"), "ord").select("title_id", "person_key", "role", "billing", "ord")


def entry_fallbacks(spark: SparkSession, sf: str) -> DataFrame:
    p, k = _table(spark, sf, "part"), F.col("p_partkey")
    entry = lambda rest, kind: p.where(k % rest == 0).select(k.alias("query_id"), _text(kind, k).alias("entry"), (F.col("p_size") < 25).alias("fresh"))
    return store.with_fallbacks(p.select(k.alias("query_id")), entry(5, "k"), entry(3, "c"), entry(2, "l"))


def aliases_linked(spark: SparkSession, sf: str) -> DataFrame:
    s, n = _table(spark, sf, "supplier"), F.col("s_suppkey")
    held = s.select(n.cast("long").alias("title_id"), F.when(n % 4 != 0, _text("tt", n % 20)).otherwise("").alias("imdb_id"))
    c, k = _table(spark, sf, "customer"), F.col("c_custkey")
    aliases = c.select(F.col("c_name").alias("alias"), F.when(k % 5 == 0, k.cast("long")).alias("title_id"), _text("tt", k % 30).alias("imdb_id"))
    return store.link_aliases(aliases, held).select("alias", "title_id")


def rows_without_titles(spark: SparkSession, sf: str) -> DataFrame:
    keys = _table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return store.without_titles(_table(spark, sf, "customer").select("c_custkey", "c_name"), keys, ["c_custkey"])


def curated_hints(spark: SparkSession, sf: str) -> DataFrame:
    c = _table(spark, sf, "customer")
    segment = F.lower("c_mktsegment")
    aliases = c.where("c_mktsegment <> 'MACHINERY'").select(segment.alias("norm")).distinct().withColumn("aliases", F.array(F.concat("norm", F.lit(" one")), F.concat("norm", F.lit(" two"))))
    return store.curated_hints(c.select(F.col("c_custkey").alias("query_id"), F.upper(segment).alias("title")), aliases)


def method_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return common.histogram(_table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey"), "l_returnflag", "l_orderkey")


def genre_table(spark: SparkSession, sf: str) -> DataFrame:
    p, k = _table(spark, sf, "part"), F.col("p_partkey")
    ids = F.array(F.element_at(F.array(F.lit(28), F.lit(10765), F.lit(16), F.lit(5)), (k % 4 + 1).cast("int")), F.lit(18))
    names = F.array(F.element_at(F.array(F.lit("Sci-Fi"), F.lit(" Drama "), F.lit("Odd Genre"), F.lit("")), (k % 3 + 1).cast("int")), F.lit("Драма"))
    media = F.when(F.col("p_size") % 2 == 0, "movie").otherwise("series")
    return p.select("p_partkey", F.array_join(titles.genre_names(ids, names, media), ",").alias("genres"))


def title_types(spark: SparkSession, sf: str) -> DataFrame:
    names = ["movie", "tvMovie", "tvSeries", "tvEpisode", "tvShort", "tvSpecial", "short", "videoGame", "TVMINISERIES", "video", ""]
    kind = F.element_at(F.array(*[F.lit(x) for x in names]), (F.col("p_partkey") % len(names) + 1).cast("int"))
    return _table(spark, sf, "part").select("p_partkey", titles.dataset_type(kind).alias("media"))


def ratings_in_texts(spark: SparkSession, sf: str) -> DataFrame:
    texts = ["IMDb rating: 7.5", "imdb рейтинг [8,1] tt0133093", "IMDb (6", "IMDb 7", "a plain text", "IMDbx 9", ""]
    desc = F.element_at(F.array(*[F.lit(x) for x in texts]), (F.col("p_partkey") % len(texts) + 1).cast("int"))
    none = F.lit(None)
    found = titles.existing_imdb(desc, none.cast("array<string>"), none.cast("array<struct<system:string,value:string>>"))
    return _table(spark, sf, "part").select("p_partkey", found["rating"].alias("rating"), found["imdb_id"].alias("imdb_id"))


QUERIES = {f.__name__: f for f in (
    entity_ratings, identity_lookup, alias_by_year, keyed_lookup, store_counts, statistics_merge, credits_merge, entry_fallbacks, aliases_linked, rows_without_titles, curated_hints, method_histogram,
    genre_table, title_types, ratings_in_texts,
)}

ORACLES = {
    "entity_ratings": """
        WITH w AS (SELECT p_partkey AS k, p_size AS s, 'tt' || p_partkey AS imdb_id FROM part),
        c AS (SELECT k, CASE WHEN k % 3 = 0 THEN '' ELSE '7' END AS rating, s::BIGINT AS votes, s AS age FROM w WHERE k % 2 = 0),
        r AS (SELECT k, (s % 10)::VARCHAR AS rating, k::BIGINT AS votes FROM w WHERE k % 3 <> 1)
        SELECT imdb_id,
            CASE WHEN c.age < CASE WHEN c.rating <> '' THEN 30 ELSE 7 END THEN c.rating WHEN r.k IS NOT NULL THEN r.rating ELSE c.rating END AS rating,
            CASE WHEN c.age < CASE WHEN c.rating <> '' THEN 30 ELSE 7 END THEN c.votes WHEN r.k IS NOT NULL THEN r.votes ELSE c.votes END AS votes,
            CASE WHEN c.age < CASE WHEN c.rating <> '' THEN 30 ELSE 7 END THEN strftime(DATE '2024-01-31' - c.age::INT, '%Y%m%d') WHEN r.k IS NOT NULL THEN '20240131'
                WHEN c.k IS NOT NULL THEN strftime(DATE '2024-01-31' - c.age::INT, '%Y%m%d') END AS checked
        FROM w LEFT JOIN c USING (k) LEFT JOIN r ON r.k = w.k
    """,
    "identity_lookup": """
        WITH t AS (SELECT s_suppkey AS id, 'tt' || s_suppkey % 60 AS imdb, (s_suppkey % 30)::VARCHAR AS tmdb, CASE WHEN s_suppkey % 2 = 0 THEN 'movie' ELSE 'series' END AS media, 'name ' || s_nationkey AS norm, (1990 + s_suppkey % 4)::VARCHAR AS year FROM supplier),
        q AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN 'tt' || c_custkey % 50 ELSE '' END AS imdb, CASE WHEN c_custkey % 3 = 1 THEN (c_custkey % 40)::VARCHAR ELSE '' END AS tmdb, CASE WHEN c_custkey % 2 = 0 THEN 'movie' ELSE 'series' END AS media, 'name ' || c_nationkey AS norm, (1990 + c_custkey % 4)::VARCHAR AS year FROM customer),
        a AS (SELECT imdb, min(id) AS id FROM t GROUP BY 1), b AS (SELECT tmdb, media, min(id) AS id FROM t GROUP BY 1, 2), c AS (SELECT norm, year, media, min(id) AS id FROM t GROUP BY 1, 2, 3)
        SELECT k AS query_id, coalesce(a.id, b.id, c.id) AS title_id FROM q LEFT JOIN a USING (imdb) LEFT JOIN b ON q.tmdb = b.tmdb AND q.media = b.media LEFT JOIN c ON q.norm = c.norm AND q.year = c.year AND q.media = c.media
    """,
    "alias_by_year": """
        WITH a AS (SELECT p_name, CASE WHEN p_size % 2 = 0 THEN '2000' ELSE '' END AS year, min(p_partkey) AS id FROM part GROUP BY 1, 2),
        q AS (SELECT p_partkey AS k, p_name, CASE p_partkey % 3 WHEN 0 THEN '2000' WHEN 1 THEN '1999' ELSE '' END AS year FROM part)
        SELECT k, coalesce(own.id, free.id) AS title_id FROM q LEFT JOIN a own ON own.p_name = q.p_name AND own.year = q.year LEFT JOIN a free ON free.p_name = q.p_name AND free.year = ''
    """,
    "keyed_lookup": "SELECT o_orderkey, c_name AS name, c_nationkey AS nation FROM orders LEFT JOIN customer ON c_custkey = o_custkey * 2",
    "store_counts": " UNION ALL ".join(f"SELECT '{n}' AS \"table\", count(*)::BIGINT AS n FROM {n}" for n in ("region", "nation", "customer", "supplier", "lineitem")),
    "statistics_merge": "SELECT event_type || '/' || user_id AS key, max(event_id) AS ord FROM events GROUP BY 1",
    "credits_merge": """
        WITH r AS (
            SELECT l_orderkey % 100 AS title_id, CASE WHEN l_suppkey % 2 = 0 THEN 'tmdb:' || l_suppkey WHEN l_suppkey % 3 = 0 THEN 'imdb:nm' || l_suppkey ELSE 'name:zed' END AS person_key,
                CASE WHEN l_linenumber % 2 = 0 THEN 'actor' ELSE 'director' END AS role, CASE WHEN l_linenumber % 3 <> 0 THEN l_linenumber::INT END AS billing, (l_orderkey * 10 + l_linenumber)::BIGINT AS ord
            FROM lineitem
        ) SELECT title_id, person_key, role, arg_max(billing, ord) FILTER (WHERE billing IS NOT NULL) AS billing, max(ord) AS ord FROM r GROUP BY 1, 2, 3
    """,
    "entry_fallbacks": """
        SELECT p_partkey AS query_id, CASE WHEN p_partkey % 5 = 0 THEN 'k' || p_partkey WHEN p_partkey % 3 = 0 AND p_size < 25 THEN 'c' || p_partkey WHEN p_partkey % 2 = 0 THEN 'l' || p_partkey END AS entry,
            CASE WHEN p_partkey % 5 = 0 THEN 'knowledge' WHEN p_partkey % 3 = 0 AND p_size < 25 THEN 'cache' WHEN p_partkey % 2 = 0 THEN 'legacy' ELSE 'none' END AS origin FROM part
    """,
    "aliases_linked": """
        WITH t AS (SELECT 'tt' || s_suppkey % 20 AS imdb, min(s_suppkey)::BIGINT AS id FROM supplier WHERE s_suppkey % 4 <> 0 GROUP BY 1)
        SELECT c_name AS alias, CASE WHEN c_custkey % 5 = 0 THEN c_custkey::BIGINT ELSE id END AS title_id FROM customer LEFT JOIN t ON imdb = 'tt' || c_custkey % 30
    """,
    "rows_without_titles": "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')",
    "curated_hints": "SELECT c_custkey AS query_id, lower(c_mktsegment) || x AS hint FROM customer, (VALUES (' one'), (' two')) v(x) WHERE c_mktsegment <> 'MACHINERY'",
    "method_histogram": "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1",
    "genre_table": """
        SELECT p_partkey, array_to_string(list_filter([CASE WHEN p_partkey % 4 = 0 AND p_size % 2 = 0 THEN 'боевик' WHEN p_partkey % 4 = 1 AND p_size % 2 = 1 THEN 'фантастика и фэнтези' WHEN p_partkey % 4 = 2 THEN 'анимация' END, 'драма',
            CASE p_partkey % 3 WHEN 0 THEN 'фантастика' WHEN 2 THEN 'odd genre' END, 'Драма'], lambda x: x IS NOT NULL), ',') AS genres FROM part
    """,
    "title_types": "SELECT p_partkey, ['movie', 'movie', 'series', '', 'series', 'series', 'movie', '', 'series', 'movie', ''][p_partkey % 11 + 1] AS media FROM part",
    "ratings_in_texts": "SELECT p_partkey, ['7.5', '8.1', '6', '7', '', '', ''][p_partkey % 7 + 1] AS rating, CASE WHEN p_partkey % 7 = 1 THEN 'tt0133093' ELSE '' END AS imdb_id FROM part",
}
