"""The registered queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, codes, decontam, langid, lm, mixing, packing, periodic, quality, rules, sharding, simhash, toxicity
from tidemark.llm.scale import WORD, crc_of_id, materialize


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    x = F.col("_mix")
    taken = F.aggregate(x["draws"], F.lit(0).cast("long"), lambda a, d: a + d["words"])
    shard = F.array_min(F.transform(x["draws"], lambda d: d["shard"]))
    return mixing.plan(docs).select("_row.doc_id", x["size"].alias("size"), x["source_size"].alias("source_size"), x["target"].alias("target"), taken.alias("taken"), F.size(x["draws"]).alias("n_draws"), shard.alias("first_shard"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = decontam.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))
    return found.select("doc_id", "contaminated", "n_items", F.array_min("items").alias("first_item"), "containment")


def op3_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return sharding.shard(docs).select("doc_id", F.col("shard_bytes").alias("size"), F.col("shard_key").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return langid.identify(docs, keep={"held_out": crc_of_id(F.col("doc_id")) % langid.FOLDS == 0})


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return simhash.near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    found = quality.score(docs, labels, {"doc_id": F.col("doc_id"), "held_out": crc_of_id(F.col("doc_id")) % toxicity.FOLDS == 0})
    return found.select("doc_id", "held_out", F.col("_q_score").alias("score"), (F.col("_q_score") >= quality.GOOD).cast("int").alias("predicted"))


def op7_format_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], said.schema)
    return chat.digests(chat.format_windows(said.unionByName(more)))


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_held_out(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    found = toxicity.score(docs, labels, {"doc_id": F.col("doc_id"), "held_out": crc_of_id(F.col("doc_id")) % toxicity.FOLDS == 0})
    return found.select("doc_id", "held_out", F.col("_tox_score").alias("score"), (F.col("_tox_score") >= toxicity.TOXIC).cast("int").alias("predicted"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return rules.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    planted = docs.withColumn("text", periodic.with_repeats(F.col("doc_id"), F.col("text"), WORD))
    found = periodic.find_runs(planted, {"doc_id": F.col("doc_id")})
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    best = F.col("best")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), periodic.strongest(F.col("runs")).alias("best")
    ).select("doc_id", "n_runs", best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"), F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    rows, first = codes.usable(table, "embedding", "vec_id")
    books = codes.learn(rows, first, "embedding") if len(first) else []
    coded = codes.encode(rows, books, "embedding", {"vec_id": F.col("vec_id"), "label": F.col("label")})
    digits = F.array_join(F.transform("code", lambda x: F.lower(F.lpad(F.hex(x), 2, "0"))), "")
    coded = materialize(coded.select("vec_id", "label", digits.alias("code"), "error"), "op12-codes")
    sums = materialize(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "op12-labels").withColumnRenamed("label", "of")
    joined = coded.join(sums, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.sha2(F.lit(codes.books_text(books)), 256).alias("codebooks_sha256"))


def op13_best_fit_pack(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return packing.pack(docs, tokenizer, {"doc_id": F.col("doc_id")})


QUERIES = {f.__name__: f for f in (op1_mix_sources, op2_decontaminate, op3_shard, op4_language, op5_simhash, op6_quality, op7_format_chat, op8_lm_score, op9_toxicity, op10_quality_rules, op11_periodic_runs, op12_vector_codes, op13_best_fit_pack)}

_SHINGLES = r"""
            SELECT {id} AS id, n, CASE WHEN n >= 5 THEN list_distinct(list_transform(range(1, n - 3), lambda i: array_to_string(w[i:i+4], ' '))) WHEN n > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS g
            FROM (SELECT {id}, w, len(w)::BIGINT AS n FROM (SELECT {id}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM {table}))
"""


def _codes_sql(parts: int = codes.PARTS, entries: int = codes.ENTRIES, rounds: int = codes.ROUNDS) -> str:
    """Rounds of assignment and averaging, each a pair of common table expressions."""
    nearest = """
        {to} AS MATERIALIZED (
            SELECT vec_id, label, part, v, min(struct_pack(off, entry)) AS best
            FROM (SELECT p.vec_id, p.label, p.part, p.v, b.entry, list_sum(list_transform(list_zip(p.v, b.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS off FROM pieces p JOIN {books} b ON p.part = b.part)
            GROUP BY vec_id, label, part, v
        )"""
    mean = """
        {to} AS MATERIALIZED (
            SELECT b.part, b.entry, coalesce(m.e, b.e) AS e
            FROM {books} b LEFT JOIN (
                SELECT part, entry, list(m ORDER BY place) AS e
                FROM (SELECT part, best.entry AS entry, place, (floor(sum(v[place]) / count(*)))::BIGINT AS m FROM {found}, range(1, len(v) + 1) AS r(place) GROUP BY ALL)
                GROUP BY part, entry
            ) m ON b.part = m.part AND b.entry = m.entry
        )"""
    steps = []
    for k in range(rounds):
        steps += [nearest.format(to=f"near{k}", books=f"books{k}"), mean.format(to=f"books{k + 1}", books=f"books{k}", found=f"near{k}")]
    steps.append(nearest.format(to="near", books=f"books{rounds}"))
    return f"""
        WITH kept AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {codes.SCALE})::BIGINT) AS v, len(embedding) // {parts} AS width
            FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), pieces AS MATERIALIZED (SELECT vec_id, label, part, v[part * width + 1 : (part + 1) * width] AS v FROM kept, range({parts}) AS r(part)),
        books0 AS (
            SELECT p.part, f.entry, p.v AS e
            FROM pieces p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < {entries}) f USING (vec_id)
        ), {",".join(steps)},
        coded AS (
            SELECT vec_id, label, string_agg(lpad(lower(to_hex(best.entry)), 2, '0'), '' ORDER BY part) AS code, sum(best.off)::BIGINT AS error
            FROM near GROUP BY vec_id, label
        )
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
            (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) FROM books{rounds}) AS codebooks_sha256
        FROM coded
    """


ORACLES = {
    "op2_decontaminate": f"""
        WITH docs AS ({_SHINGLES.format(id="doc_id", table="documents")}),
        items AS ({_SHINGLES.format(id="item_id", table="benchmark")}),
        sought AS (SELECT id AS item_id, len(g) AS size, n, unnest(g) AS s FROM items),
        had AS (SELECT id AS doc_id, n, unnest(g) AS s FROM docs),
        found AS (
            SELECT doc_id, item_id, count(*) / any_value(size)::DOUBLE AS containment FROM had JOIN sought USING (s)
            GROUP BY doc_id, item_id HAVING count(*) >= 0.8 * any_value(size)
        ), best AS (SELECT doc_id, count(*)::BIGINT AS n, min(item_id) AS first_item, max(containment) AS containment FROM found GROUP BY doc_id)
        SELECT d.doc_id, b.doc_id IS NOT NULL AS contaminated, coalesce(b.n, 0)::BIGINT AS n_items, first_item, coalesce(containment, 0.0)::DOUBLE AS containment
        FROM documents d LEFT JOIN best b ON d.doc_id = b.doc_id
    """,
    "op12_vector_codes": _codes_sql(),
}
