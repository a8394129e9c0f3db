"""The alias stream over several runs, with rows that come late and restarts, against the batch form."""

from tidemark.operators import store
from tidemark.streaming import streams

RUNS = [
    [(5, "a", "", "movie", "tt1", 80, 0, "x"), (6, "a", "", "movie", "tt2", 99, 1, "y"), (7, "b", "1999", "movie", "tt3", 90, 1, "")],
    [(1, "a", "", "movie", "tt2", 70, 0, "late"), (8, "a", "", "movie", "tt1", 60, 1, ""), (9, "a", None, "series", "tt9", None, None, None), (10, "b", "1999", "movie", "", 50, 0, "z")],
    [(11, "a", "", "movie", "tt1", 85, 0, "w"), (12, "b", "1999", "movie", "tt3", 91, 0, "v"), (13, "c", "", "movie", "tt5", 1, 0, "u")],
]


def test_runs_late_rows_and_restarts(spark, tmp_path):
    landed, path, check = (f"{tmp_path}/{x}" for x in ("landed", "changes", "checkpoint"))
    for rows in RUNS:
        spark.createDataFrame(rows, streams.EVIDENCE).write.mode("append").parquet(landed)
        for _ in range(2):  # a second start finds nothing new
            streams.learn_aliases(spark.readStream.schema(streams.EVIDENCE).parquet(landed), path, check).awaitTermination()
    learned = {(r.alias, r.year, r.media): (r.identity, r.evidence_count, r.confidence, r.verified, r.source) for r in streams.current_aliases(spark, path).collect()}
    assert learned == {("a", "", "movie"): ("tt1", 3, 85, 1, "w"), ("a", "", "series"): ("tt9", 1, 0, 0, ""), ("b", "1999", "movie"): ("tt3", 2, 91, 1, "v"), ("c", "", "movie"): ("tt5", 1, 1, 0, "u")}
    clashes = sorted(tuple(r) for r in streams.alias_conflicts(spark, path).collect())
    assert clashes == [(1, "a", "", "movie", "tt1", "tt2"), (6, "a", "", "movie", "tt1", "tt2")]
    # the batch form over the same evidence in the order of its arrival
    arrived = [(n, r[1], r[2] or "", r[3], r[4], r[5] or 0, r[6] or 0, r[7] or "") for n, r in enumerate(x for run in RUNS for x in run) if r[4]]
    agree, clash = store.learn_aliases(spark.createDataFrame(arrived, streams.EVIDENCE))
    assert {(r.alias, r.year, r.media): (r.identity, r.evidence_count, r.confidence, r.verified) for r in agree.collect()} == {k: v[:4] for k, v in learned.items()}
    assert sum(r.n for r in clash.collect()) == len(clashes)


def test_a_run_touches_its_own_keys_only(spark, tmp_path):
    landed, path, check = (f"{tmp_path}/{x}" for x in ("landed", "changes", "checkpoint"))
    run = lambda: streams.learn_aliases(spark.readStream.schema(streams.EVIDENCE).parquet(landed), path, check).awaitTermination()
    spark.createDataFrame([(k, f"k{k}", "", "movie", "tt1", 1, 0, "") for k in range(200)], streams.EVIDENCE).write.mode("append").parquet(landed)
    run()
    spark.createDataFrame([(900, "k7", "", "movie", "tt1", 5, 1, "s")], streams.EVIDENCE).write.mode("append").parquet(landed)
    run()
    assert spark.read.parquet(path).count() == 201 and streams.current_aliases(spark, path).count() == 200


def test_many_keys_of_a_bucket_over_runs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "BUCKETS", 2)
    import random

    draw = random.Random(7)
    runs = [[(k, f"k{draw.randrange(12)}", draw.choice(["", "1999", None]), draw.choice(["movie", "series"]), draw.choice(["tt1", "tt2", "tt3", " "]), draw.choice([None, 1, 50, 99]), draw.choice([None, 0, 1]), draw.choice([None, "", "x", "y"])) for k in draw.sample(range(10_000), 150)] for _ in range(3)]
    landed, path, check = (f"{tmp_path}/{x}" for x in ("landed", "changes", "checkpoint"))
    known, clashes = {}, []
    for rows in runs:
        spark.createDataFrame(rows, streams.EVIDENCE).write.mode("append").parquet(landed)
        streams.learn_aliases(spark.readStream.schema(streams.EVIDENCE).parquet(landed), path, check).awaitTermination()
        for ord_, alias, year, media, identity, confidence, verified, source in sorted(rows):
            if identity.strip():
                key = (alias, year or "", media)
                had = known.setdefault(key, [identity, 0, 0, 0, ""])
                if had[0] == identity:
                    known[key] = [identity, had[1] + 1, max(had[2], confidence or 0), max(had[3], verified or 0), source or had[4]]
                else:
                    clashes.append((ord_, *key, had[0], identity))
    assert {(r.alias, r.year, r.media): [r.identity, r.evidence_count, r.confidence, r.verified, r.source] for r in streams.current_aliases(spark, path).collect()} == known
    assert sorted(tuple(r) for r in streams.alias_conflicts(spark, path).collect()) == sorted(clashes) and len(known) > 40
