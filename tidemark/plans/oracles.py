"""The same questions in DuckDB's SQL, written on their own for comparison."""

_PROG = """
    prog AS (
        SELECT event_id, user_id::VARCHAR AS channel, ts AS start_at, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS stop_at, event_type AS title FROM events
    ), secs AS (SELECT event_id, channel, date_trunc('second', start_at) AS start_at, date_trunc('second', stop_at) AS stop_at, title FROM prog)
"""
_AT = "TIMESTAMP '2024-01-15 12:00:00'"
_DELIVERY = """
    d AS (
        SELECT 'c' || o_custkey AS name, CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'NO_EPG_1' ELSE 'id' || o_custkey END AS actual, CASE WHEN o_orderkey % 3 = 0 THEN 'hint' ELSE '' END AS tvg_name, o_orderpriority AS grp FROM orders
    ), mapping AS (SELECT 'c' || c_custkey AS name, 'id' || c_custkey AS expected FROM customer WHERE c_custkey % 4 <> 0),
    valid AS (SELECT 'id' || c_custkey AS id FROM customer WHERE c_custkey % 3 <> 0),
    seen AS (SELECT name, count(*) AS n FROM d GROUP BY name),
    rows_ AS (
        SELECT d.*, coalesce(mapping.expected, '') AS expected, coalesce(mapping.expected, '') IN (SELECT id FROM valid) AS ok FROM d LEFT JOIN mapping USING (name)
    ), a AS (
        SELECT r.name, r.grp, r.expected AS expected_id, r.actual AS tvg_id, r.ok AS validated, seen.n::BIGINT AS copies,
            coalesce(nullif(concat_ws(';', CASE WHEN expected <> '' AND actual <> expected THEN 'wrong_tvg_id' END, CASE WHEN expected <> '' AND NOT ok THEN 'no_validated_programme' END,
                CASE WHEN expected = '' AND grp IN ('1-URGENT') AND (actual <> '' OR tvg_name <> '') THEN 'protected_unmatched_has_epg_hint' END,
                CASE WHEN expected = '' AND starts_with(lower(actual), 'no_epg') THEN 'placeholder_tvg_id_left' END), ''), 'ok') AS issues
        FROM rows_ r JOIN seen USING (name)
        UNION ALL SELECT name, '', expected, '', expected IN (SELECT id FROM valid), 0::BIGINT, 'mapped_channel_missing_from_worker' FROM mapping WHERE name NOT IN (SELECT name FROM seen)
    )
"""
_EVIDENCE = """
    ev AS (
        SELECT p_name AS alias, l_returnflag AS media, (l_suppkey % 3)::VARCHAR AS identity, (90 + l_linenumber)::INT AS confidence, CASE WHEN l_linenumber > 6 THEN 1 ELSE 0 END AS verified, l_linestatus AS source,
            row_number() OVER (PARTITION BY p_name, l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_partkey) AS n
        FROM lineitem JOIN part ON l_partkey = p_partkey
    ), fst AS (SELECT alias, media, identity AS first_identity FROM ev WHERE n = 1)
"""
_MAP = """
    m AS (
        SELECT s_suppkey AS k, ['Discovery ', 'Plain ', 'HBO '][s_suppkey % 3 + 1] || s_suppkey AS playlist_name, ['.ro', '', '.it', '.uk', ''][s_suppkey % 5 + 1] AS suffix, ['RO', 'IT', '', 'GB'][s_suppkey % 4 + 1] AS region,
            ['feed0', 'feed1'][s_suppkey % 2 + 1] AS source, ['alias', 'id', 'name', 'name-region', 'synthetic-x', 'id'][s_suppkey % 6 + 1] AS method, [100, 99, 90, 96, 50, 95][s_suppkey % 6 + 1] AS confidence
        FROM supplier
    )
"""
_LEV = "CASE WHEN a.t = c.p_name THEN 1.0 ELSE 1 - levenshtein(a.t, c.p_name) / greatest(length(a.t), length(c.p_name))::DOUBLE END"

ORACLES = {
    "guide_coverage": """
        SELECT c_mktsegment AS grp, count(*) AS total, count(*) FILTER (s = 0) AS baseline, count(s) AS matched, count(s) - count(*) FILTER (s = 0) AS added, round(100.0 * count(s) / count(*), 1)::DOUBLE AS pct
        FROM (SELECT *, CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 3 = 0 THEN 0 WHEN c_custkey % 2 = 0 THEN 1 END AS s FROM customer) GROUP BY 1
    """,
    "resolve_cascade_two_pass": """
        WITH c AS (SELECT c_custkey AS k, c_mktsegment IN ('BUILDING', 'MACHINERY') AS in1, c_custkey % 22 = 0 AS pinned FROM customer),
        r AS (
            SELECT k, CASE WHEN in1 AND k % 2 = 0 AND k % 11 = 0 THEN 'alias1' WHEN in1 AND k % 2 = 0 THEN 'name1' WHEN pinned THEN NULL
                WHEN k % 7 <> 0 AND k % 3 = 0 THEN 'id2' WHEN k % 4 = 0 AND k % 10 <> 0 THEN 'name2' END AS how FROM c
        )
        SELECT k AS channel_index, CASE WHEN k % 13 = 0 THEN 'fix' || k WHEN k % 7 <> 0 THEN 'ch' || k ELSE sid END AS output_tvg_id, 'feed' || how[-1] AS source, sid AS source_id,
            how[1:-2] AS method, CASE how[1:-2] WHEN 'alias' THEN 100 WHEN 'id' THEN 99 ELSE 90 END::INT AS confidence, 1::INT AS pass
        FROM (SELECT *, CASE WHEN how[-1] = '1' THEN 'n' WHEN how = 'id2' THEN 'ch' ELSE 'm' END || k AS sid FROM r WHERE how IS NOT NULL)
    """,
    "unresolved_channels": "SELECT c_mktsegment AS grp, count(*) AS n FROM customer WHERE NOT (c_custkey % 7 <> 0 AND c_custkey % 3 = 0) GROUP BY 1",
    "programme_windows": f"""
        WITH {_PROG} SELECT channel AS output_tvg_id, count(*) AS programmes, count(*) FILTER ((stop_at IS NULL OR stop_at >= {_AT} - INTERVAL 6 HOUR) AND start_at <= {_AT} + INTERVAL 48 HOUR) AS usable
        FROM secs WHERE start_at::DATE BETWEEN DATE '2024-01-10' AND DATE '2024-02-05' GROUP BY 1
    """,
    "guide_fan_out": f"""
        WITH {_PROG}, kept AS (
            SELECT channel, (stop_at IS NULL OR stop_at >= {_AT} - INTERVAL 6 HOUR) AND start_at <= {_AT} + INTERVAL 48 HOUR AS usable FROM secs WHERE start_at::DATE BETWEEN DATE '2024-01-10' AND DATE '2024-02-05'
        ), m AS (SELECT c_custkey AS channel_index, (c_custkey % 200)::VARCHAR AS sid, 'out' || (c_custkey % 300) AS output_tvg_id FROM customer),
        n AS (SELECT output_tvg_id, count(*) AS programmes, count(*) FILTER (usable) AS usable FROM kept JOIN (SELECT DISTINCT sid, output_tvg_id FROM m) ON channel = sid GROUP BY 1)
        SELECT channel_index, m.output_tvg_id, coalesce(programmes, 0)::BIGINT AS programmes, coalesce(usable, 0)::BIGINT AS usable, coalesce(programmes, 0) > 0 AND coalesce(usable, 0) > 0 AS valid FROM m LEFT JOIN n USING (output_tvg_id)
    """,
    "now_next": f"""
        WITH {_PROG}
        SELECT channel, 0::INT AS place, arg_max(title, start_at) AS title, max(start_at) AS start_at FROM secs WHERE start_at <= {_AT} AND (stop_at IS NULL OR stop_at > {_AT}) GROUP BY 1
        UNION ALL SELECT channel, place::INT, title, start_at FROM (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY start_at) AS place FROM secs WHERE start_at > {_AT}) WHERE place <= 8
    """,
    "watchlist_diagnostics": f"""
        WITH {_PROG}, w AS (SELECT c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN c_custkey::VARCHAR END AS channel FROM customer WHERE c_custkey % 3 = 0),
        o AS (SELECT channel, arg_max(title, start_at) AS on_air FROM secs WHERE start_at <= {_AT} AND (stop_at IS NULL OR stop_at > {_AT}) GROUP BY 1),
        u AS (SELECT channel, string_agg(title, ',' ORDER BY start_at) AS up FROM (SELECT *, row_number() OVER (PARTITION BY channel ORDER BY start_at) AS n FROM secs WHERE start_at > {_AT}) WHERE n <= 3 GROUP BY 1)
        SELECT name, CASE WHEN w.channel IS NULL THEN 'not_mapped' WHEN on_air IS NULL AND up IS NULL THEN 'no_current_or_upcoming_programme' ELSE 'ok' END AS status, on_air, coalesce(up, '') AS upcoming
        FROM w LEFT JOIN o ON w.channel = o.channel LEFT JOIN u ON w.channel = u.channel
    """,
    "clock_offset_prefix": """
        SELECT url AS source_id, CASE WHEN min(page_id % 10) = 0 THEN 0 WHEN url LIKE 'http://thth%' THEN -120 WHEN url LIKE 'http://th%' THEN 60 WHEN url LIKE 'http://a%' THEN 30 ELSE 0 END::INT AS offset_minutes FROM pages GROUP BY url
    """,
    "timestamp_text_roundtrip": """
        WITH t AS (
            SELECT event_id, [8, 10, 12, 14][event_id % 4 + 1] AS n, CASE event_id % 5 WHEN 0 THEN 'Z' WHEN 1 THEN ' -0730' WHEN 4 THEN '' ELSE ' +0300' END AS zone,
                CASE event_id % 5 WHEN 0 THEN 0 WHEN 1 THEN -450 WHEN 4 THEN NULL ELSE 180 END AS off, ts FROM events
        ), l AS (
            SELECT *, strftime(ts, '%Y%m%d%H%M%S')[1:n] AS d, date_trunc(CASE n WHEN 8 THEN 'day' WHEN 10 THEN 'hour' WHEN 12 THEN 'minute' ELSE 'second' END, ts) AS local FROM t
        ), u AS (SELECT *, local - to_minutes(off) AS instant_at FROM l)
        SELECT event_id, instant_at, CASE WHEN off IS NULL THEN d ELSE strftime(local + INTERVAL 90 MINUTE, '%Y%m%d%H%M%S')[1:n] || ' ' || CASE zone WHEN 'Z' THEN '+0000' ELSE trim(zone) END END AS shifted,
            CASE WHEN off IS NULL THEN d ELSE strftime(instant_at - INTERVAL 8 HOUR, '%Y%m%d%H%M%S')[1:n] || ' -0800' END AS converted FROM u
    """,
    "snapshot_diff": """
        WITH e AS (SELECT *, user_id::VARCHAR AS key, CASE WHEN value > 50 THEN 'high' ELSE 'low' END AS grp FROM events),
        a AS (SELECT key, arg_max(event_type, (ts, event_id)) AS name, arg_max(grp, (ts, event_id)) AS grp, arg_max(props, (ts, event_id)) AS url FROM e WHERE ts < TIMESTAMP '2024-01-15' AND user_id % 5 <> 0 GROUP BY 1),
        b AS (SELECT key, arg_max(event_type, (ts, event_id)) AS name, arg_max(grp, (ts, event_id)) AS grp, arg_max(props, (ts, event_id)) AS url FROM e WHERE ts >= TIMESTAMP '2024-01-15' AND user_id % 7 <> 0 GROUP BY 1)
        SELECT key, 'added' AS change, NULL::VARCHAR AS before, name AS after FROM b WHERE key NOT IN (SELECT key FROM a)
        UNION ALL SELECT key, 'removed', name, NULL FROM a WHERE key NOT IN (SELECT key FROM b)
        UNION ALL SELECT key, 'renamed', a.name, b.name FROM a JOIN b USING (key) WHERE a.name <> b.name
        UNION ALL SELECT key, 'url', a.url, b.url FROM a JOIN b USING (key) WHERE a.url <> b.url
        UNION ALL SELECT key, 'group', a.grp, b.grp FROM a JOIN b USING (key) WHERE a.grp <> b.grp
    """,
    "delivery_audit": f"WITH {_DELIVERY} SELECT * FROM a",
    "delivery_issue_counts": f"WITH {_DELIVERY} SELECT issue, count(*) AS n FROM (SELECT unnest(string_split(issues, ';')) AS issue FROM a WHERE issues <> 'ok') GROUP BY 1",
    "accuracy_audit": f"""
        WITH {_MAP}, v AS (
            SELECT k, CASE WHEN k % 9 = 0 THEN 'verified|by hand' WHEN method = 'synthetic-x' THEN 'wrong|synthetic schedule is not a verified real broadcast schedule'
                WHEN region <> '' AND suffix <> '' AND region <> CASE suffix WHEN '.ro' THEN 'RO' WHEN '.it' THEN 'IT' ELSE 'GB' END
                    THEN 'wrong|explicit XMLTV country ' || CASE suffix WHEN '.ro' THEN 'RO' WHEN '.it' THEN 'IT' ELSE 'GB' END || ' conflicts with provider region ' || region
                WHEN region = 'IT' AND source = 'feed0' AND k % 3 <> 1 THEN 'wrong|regional-sensitive brand matched from an incompatible country feed'
                WHEN method = 'alias' THEN 'verified|researched exact alias' WHEN method IN ('id', 'name-region') AND confidence >= 96 THEN 'probable|strong exact match; no country conflict detected'
                ELSE 'unverified|mapping has not yet been cross-checked against an independent schedule' END AS t FROM m
        )
        SELECT k AS channel_index, split_part(t, '|', 1) AS accuracy_status, split_part(t, '|', 2) AS accuracy_reason, split_part(t, '|', 1) = 'wrong' AS quarantine FROM v
    """,
    "quarantine_and_sources": f"WITH {_MAP} SELECT source, count(*) AS matched, 0::BIGINT AS family_recovered, round(avg(confidence), 1)::DOUBLE AS confidence FROM m WHERE method <> 'synthetic-x' GROUP BY 1",
    "longest_rule_first_match": """
        SELECT p_partkey AS ord, CASE WHEN p_size * 10 >= 300 AND (lower(p_brand) LIKE '%brand#1%' OR lower(p_brand) LIKE '%brand#2%') THEN '1-' || p_name WHEN p_size * 10 >= 100 THEN '2-' || p_name END AS rule_id FROM part
    """,
    "normalize_names": """
        SELECT p_partkey, lower(p_name) || ' еж' AS key, p_partkey % 4 <> 0 AS real, lower(p_name) || ' еж|1999|movie|ru' AS cache_key FROM part
    """,
    "clean_titles": r"""
        WITH n AS (SELECT p_partkey, p_partkey % 5 AS k, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS t FROM part)
        SELECT p_partkey, t AS title, CASE WHEN k IN (1, 3, 4) THEN 'series' ELSE 'movie' END AS media,
            t || CASE k WHEN 0 THEN ' (16+)' WHEN 1 THEN '. 5 с.' WHEN 2 THEN ' (2019)' WHEN 3 THEN ' (Эпизод один)' ELSE ', 3 и 4 с.' END AS bare FROM n
    """,
    "compact_titles": r"""
        WITH n AS (SELECT p_partkey, (1960 + p_size)::VARCHAR AS y, CASE WHEN p_partkey % 4 = 3 THEN (1960 + p_size)::VARCHAR ELSE array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') END AS t FROM part),
        c AS (SELECT p_partkey, t || ' (' || y || ') · IMDb 7.1' AS title FROM n)
        SELECT p_partkey, title, title AS again, title AS tidy FROM c
    """,
    "page_titles": r"""
        SELECT array_to_string(list_filter(regexp_split_to_array(lower(regexp_extract(html, '<title>(.*?)</title>', 1)), '[^\p{L}\p{N}_]+'), lambda t: t <> '' AND t NOT IN ('uhd', 'fhd', 'hd', 'sd', '4k', '8k', 'hdr', 'hevc', 'h265')), ' ') AS key, count(*) AS n
        FROM pages GROUP BY 1
    """,
    "language_gate": r"""
        SELECT language, count(*) AS n, CASE WHEN language IN ('ru', 'en') THEN count(*) ELSE 0 END AS kept FROM (
            SELECT CASE WHEN len(regexp_extract_all(text, '[A-Za-z]')) >= 3 THEN 'en' WHEN regexp_matches(lower(text), '\b(the|a|an|and|or|of|to|in|on|for|with)\b') THEN 'en' WHEN lang = 'en' THEN 'en' ELSE 'unknown' END AS language FROM documents
        ) GROUP BY 1
    """,
    "media_type_case": """
        SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN '' WHEN 1 THEN 'series' WHEN 2 THEN 'movie' ELSE CASE WHEN p_size = 7 OR p_partkey % 6 = 3 THEN 'series' WHEN p_size > 40 THEN 'movie' ELSE '' END END AS media,
            CASE p_partkey % 6 WHEN 0 THEN false WHEN 1 THEN true WHEN 2 THEN true WHEN 3 THEN true WHEN 4 THEN false ELSE p_size > 40 END AS fiction FROM part
    """,
    "queue_dedupe_priority": """
        WITH r AS (
            SELECT p_name AS key, year(l_shipdate)::VARCHAR AS year, CASE WHEN p_size > 45 THEN 0 WHEN l_linenumber = 1 THEN 1 ELSE 3 END::INT AS priority, l_suppkey AS channel FROM lineitem JOIN part ON l_partkey = p_partkey
        ) SELECT key, year, priority, channel FROM r QUALIFY row_number() OVER (PARTITION BY key, year ORDER BY priority, channel) = 1
    """,
    "negative_cache_ttl": """
        WITH s AS (SELECT *, CASE WHEN o_orderstatus = 'F' THEN 'not_found' WHEN o_orderstatus = 'O' THEN 'no_imdb_id' WHEN o_orderkey % 2 = 0 THEN 'found' ELSE 'error' END AS st, greatest(1, o_orderkey % 5) AS m FROM orders),
        d AS (SELECT *, CASE st WHEN 'not_found' THEN CASE WHEN m <= 1 THEN 2 WHEN m <= 3 THEN 7 ELSE 30 END WHEN 'no_imdb_id' THEN CASE WHEN m <= 2 THEN 14 ELSE 30 END ELSE 3 END AS days FROM s)
        SELECT o_orderkey, st = 'found' OR o_orderdate > TIMESTAMP '1997-01-01' - to_days(days::INT) AS fresh, st = 'found' AND o_orderdate <= TIMESTAMP '1996-12-25' AS retry FROM d
    """,
    "nonempty_upsert": """
        WITH r AS (
            SELECT l_partkey, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey) AS n, CASE WHEN (l_orderkey + l_linenumber) % 3 = 0 THEN NULL ELSE l_returnflag END AS f,
                CASE WHEN (l_orderkey + l_linenumber) % 2 = 0 THEN NULL ELSE l_suppkey::VARCHAR END AS s, CASE WHEN (l_orderkey + l_linenumber) % 4 = 0 THEN '' ELSE l_linestatus END AS t FROM lineitem
        )
        SELECT l_partkey, coalesce(arg_max(f, n) FILTER (f IS NOT NULL), '') AS flag, coalesce(arg_max(s, n) FILTER (s IS NOT NULL), '') AS supplier, arg_max(t, n) AS status FROM r GROUP BY 1
    """,
    "alias_learning": f"""
        WITH {_EVIDENCE} SELECT alias, media, identity, count(*) AS evidence_count, max(confidence) AS confidence, max(verified)::INT AS verified, arg_max(source, n) AS source
        FROM ev JOIN fst USING (alias, media) WHERE identity = first_identity GROUP BY 1, 2, 3
    """,
    "alias_conflicts": f"WITH {_EVIDENCE} SELECT alias, media, first_identity, identity, count(*) AS n FROM ev JOIN fst USING (alias, media) WHERE identity <> first_identity GROUP BY 1, 2, 3, 4",
    "alias_teaching": """
        WITH f AS (SELECT p_name, 95 + p_partkey % 5 AS c FROM part WHERE p_partkey % 5 >= 2), w AS (
            SELECT 'х/ф ' || p_name || ' 4k' AS alias, p_name AS identity, c FROM f UNION ALL SELECT p_name || ' 4k', p_name, c FROM f UNION ALL SELECT p_name, p_name, c - 1 FROM f
        ) SELECT alias, identity, count(*) AS evidence_count, max(c)::INT AS confidence, max(CASE WHEN c >= 97 THEN 1 ELSE 0 END)::INT AS verified FROM w GROUP BY 1, 2
    """,
    "knowledge_resolution": """
        WITH q AS (SELECT p_partkey AS id, p_name, p_partkey % 2 = 0 AS marked, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE (1990 + p_partkey % 10)::VARCHAR END AS y, CASE WHEN p_size > 25 THEN 'movie' ELSE 'series' END AS media FROM part),
        a AS (SELECT p_name, min(p_partkey) AS t FROM part WHERE p_partkey % 4 = 0 GROUP BY 1), t AS (SELECT p_partkey AS t, p_name, (1990 + p_partkey % 10)::VARCHAR AS y FROM part),
        r AS (
            SELECT id AS query_id, a.t AS title_id, CASE WHEN marked THEN 3 WHEN y = '' THEN 1 ELSE 2 END AS rank FROM q JOIN a USING (p_name) WHERE media = 'movie'
            UNION ALL SELECT id, min(t.t), 4 FROM q JOIN t ON q.p_name = t.p_name AND q.y = t.y WHERE media = 'series' AND NOT marked GROUP BY id
            UNION ALL SELECT id, min(t.t), 5 FROM q JOIN t ON q.p_name = t.p_name WHERE media = 'series' AND NOT marked AND q.y = '' GROUP BY id HAVING count(DISTINCT t.t) = 1
        )
        SELECT query_id, title_id, CASE rank WHEN 1 THEN 'alias' WHEN 2 THEN 'alias-yearless' WHEN 3 THEN 'variant' WHEN 4 THEN 'canonical' ELSE 'unique-title' END AS rule, CASE rank WHEN 3 THEN 98 WHEN 4 THEN 99 WHEN 5 THEN 99 ELSE 98 END::INT AS confidence FROM r
    """,
    "reference_join": """
        SELECT 'tt' || lpad(p_partkey::VARCHAR, 7, '0') AS tconst, p_name AS primaryTitle, coalesce(r::VARCHAR, '') AS rating, coalesce(n, 0)::BIGINT AS votes
        FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n, min(l_linenumber) AS r FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) ON p_partkey = l_partkey
    """,
    "credits_top8": """
        WITH c AS (SELECT *, coalesce(CASE WHEN l_quantity > 10 THEN l_quantity::INT END, 999999) AS b FROM lineitem), a AS (
            SELECT l_orderkey, string_agg(l_partkey::VARCHAR, ',' ORDER BY n) AS actors FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY b, l_linenumber, l_partkey) AS n FROM c WHERE l_linenumber <> 1) WHERE n <= 3 GROUP BY 1
        ), d AS (SELECT l_orderkey, string_agg(l_partkey::VARCHAR, ',' ORDER BY b, l_linenumber, l_partkey) AS directors FROM c WHERE l_linenumber = 1 GROUP BY 1)
        SELECT l_orderkey AS title_id, coalesce(directors, '') AS directors, coalesce(actors, '') AS actors FROM (SELECT DISTINCT l_orderkey FROM lineitem) LEFT JOIN a USING (l_orderkey) LEFT JOIN d USING (l_orderkey)
    """,
    "budgeted_topn": """
        SELECT CASE o_orderkey % 5 WHEN 1 THEN 1 WHEN 2 THEN 0 ELSE 2 END::INT AS rank, o_orderpriority AS priority, o_orderstatus AS grp, o_orderkey AS title FROM orders WHERE o_orderkey % 5 IN (1, 2, 3)
        ORDER BY 1, 2, 3, 4, year(o_orderdate) LIMIT 200
    """,
    "queue_completeness": """
        WITH k AS (SELECT o_orderkey % 6 AS k FROM orders)
        SELECT count(*) AS total, count(*) FILTER (k = 5) AS complete, count(*) FILTER (k IN (3, 4)) AS partial, count(*) FILTER (k = 0) AS unknown, count(*) FILTER (k = 2) AS retryable, count(*) FILTER (k = 1) AS negative_fresh,
            count(*) FILTER (k = 5) AS with_overview, count(*) FILTER (k > 3) AS with_genres, count(*) FILTER (k = 5) AS with_imdb_id, count(*) FILTER (k IN (0, 2, 3, 4)) AS remaining FROM k
    """,
    "plan_cutoff": """
        WITH l AS (SELECT l_orderkey, l_linenumber, l_quantity > 40 AS hit, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS pos FROM lineitem), s AS (
            SELECT *, hit OR coalesce(NOT lag(hit) OVER (PARTITION BY l_orderkey ORDER BY pos), false) AS stop FROM l
        )
        SELECT l_orderkey, l_linenumber, hit FROM s QUALIFY coalesce(sum(stop::INT) OVER (PARTITION BY l_orderkey ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0
    """,
    "family_report": """
        WITH d AS (SELECT p_partkey AS ord, p_brand AS grp, p_size < 10 AS dummy, ['Magic ', 'BCU Media ', 'HD ', '', 'CPS '][p_partkey % 5 + 1] || p_name AS name, CASE p_partkey % 5 WHEN 0 THEN 'Magic' WHEN 1 THEN 'BCU' WHEN 4 THEN 'CPS' ELSE 'Other: ' || split_part(p_name, ' ', 1) END AS family FROM part),
        g AS (SELECT family, string_agg(grp || ':' || n, ',' ORDER BY n DESC, o) AS groups FROM (SELECT family, grp, count(*) AS n, min(ord) AS o FROM d GROUP BY 1, 2) GROUP BY 1)
        SELECT family, count(*) AS n, count(*) FILTER (dummy) AS dummy_ids, any_value(groups) AS groups, arg_min(name, ord) AS first_channel FROM d JOIN g USING (family) GROUP BY 1
    """,
    "history_ranking": """
        WITH r AS (SELECT strftime(o_orderdate, '%Y-%m') AS run, o_orderpriority AS source, count(*) FILTER (o_totalprice > 300000) AS added FROM orders GROUP BY 1, 2)
        SELECT source, count(DISTINCT run) AS runs, sum(added)::BIGINT AS total_added, count(*) FILTER (added > 0) AS successful_runs FROM r WHERE run IN (SELECT DISTINCT run FROM r ORDER BY run DESC LIMIT 24) GROUP BY 1
    """,
    "playlist_roundtrip": """
        WITH b AS (SELECT c_custkey AS k, c_name AS name, CASE WHEN c_custkey % 10 = 0 THEN 'Regrouped' ELSE c_mktsegment END AS grp, CASE WHEN c_custkey % 7 = 0 THEN 'no_epg_' ELSE 'ch' END || c_custkey AS id FROM customer WHERE c_mktsegment <> 'AUTOMOBILE')
        SELECT name, CASE WHEN k % 3 = 0 THEN 'out$' || k WHEN grp = 'BUILDING' OR k % 7 = 0 THEN '' ELSE id END AS tvg_id, CASE WHEN k % 3 <> 0 AND (grp = 'BUILDING' OR k % 7 = 0) THEN '' ELSE name END AS tvg_name, grp, 'http://example.test/' || k AS stream_url FROM b
    """,
    "xml_roundtrip": f"""
        WITH {_PROG} SELECT channel, count(*) AS n, strftime(min(start_at), '%Y%m%d%H%M%S') || ' +0000' AS first, '<&> ' || max(title) AS desc, 'user ' || channel AS norm FROM secs WHERE stop_at IS NOT NULL GROUP BY channel
    """,
    "title_levenshtein_top1": f"""
        WITH n AS (SELECT p_partkey, p_name || ' ' || p_type AS name FROM part), a AS (SELECT p_partkey AS query_id, name[1:length(name) - p_partkey % 3] || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'e' END AS t FROM n),
        c AS (SELECT name AS p_name, min(p_partkey) AS id FROM n GROUP BY 1), s AS (SELECT query_id, id, lower(a.t) = lower(c.p_name) AS same, {_LEV} AS sim FROM a, c)
        SELECT query_id, id, round(sim, 6)::DOUBLE AS similarity, CASE WHEN same THEN 98 WHEN sim >= 0.95 THEN 95 WHEN sim >= 0.9 THEN 92 WHEN sim >= 0.84 THEN 88 ELSE 84 END::INT AS confidence
        FROM s WHERE sim >= 0.82 QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, id) = 1
    """,
    "synthetic_schedule": f"""
        SELECT s_name AS name, 'synthetic.' || sha1_hex AS id, b::INT AS block, {_AT} - INTERVAL 4 HOUR + to_hours(4 * b) AS start_at, {_AT} + to_hours(4 * b) AS stop_at
        FROM (SELECT s_name, sha1(s_name)[1:12] AS sha1_hex FROM supplier), range(49) t(b)
    """,
    "alias_stream": """
        WITH f AS (SELECT user_id, arg_min(event_type, (ts, event_id)) AS identity FROM events GROUP BY 1)
        SELECT e.user_id::VARCHAR AS alias, identity, count(*) AS evidence_count, max(trunc(value)::INT) AS confidence FROM events e JOIN f ON e.user_id = f.user_id AND e.event_type = f.identity GROUP BY 1, 2
    """,
    "guide_stream": "SELECT ts::DATE::VARCHAR AS start_date, count(DISTINCT (user_id, ts)) AS n, count(DISTINCT user_id) AS channels FROM events GROUP BY 1",
}
