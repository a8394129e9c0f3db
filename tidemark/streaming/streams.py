"""The two recurring runs as streams: guide ingest with a freshness window, and alias learning."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

LATE = "5 days"
EVIDENCE = "ord bigint, alias string, year string, media string, identity string, confidence int, verified int, source string"


def ingest_guide(programmes: DataFrame, late: str = LATE) -> DataFrame:
    """A stream of programmes (source_index, channel, start_at, ...) without repeats; rows older than the archive are dropped."""
    return programmes.withWatermark("start_at", late).dropDuplicatesWithinWatermark(["source_index", "channel", "start_at"])


def guide_to_table(programmes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Everything that has arrived, appended once, by source and date."""
    out = ingest_guide(programmes).withColumn("start_date", F.to_date("start_at"))
    return out.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy("source_index", "start_date").trigger(availableNow=True).start()


STATE = "identity string, evidence_count bigint, confidence int, verified int, source string"
#: What a batch appends: for each key that it touched the learned row as it stands, and each row that disagreed.
CHANGES = f"kind string, alias string, year string, media string, {STATE}, ord bigint, known_identity string"
KEYS = ["alias", "year", "media"]
#: Keys are learned by buckets of their hash: a call of Python for each key would take longer than all that is done in it.
BUCKETS = 4096


def _learner():
    """A state for each (alias, year, media), kept by bucket, and how evidence changes it. A batch reads and writes the states of its own keys.

    Defined inside a function, so that it travels to the workers with the query.
    """

    class Learner(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.learned = handle.getMapState("learned", ", ".join(f"{k} string" for k in KEYS), STATE)

        def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803
            batch = pd.concat(list(rows)).sort_values("ord", kind="stable").reset_index(drop=True)
            group = batch.groupby(KEYS, sort=False).ngroup().to_numpy()
            start = np.unique(group, return_index=True)[1]
            names = list(batch.loc[start, KEYS].itertuples(index=False, name=None))
            identity, text = batch["identity"].to_numpy(object), batch["source"].to_numpy(object)
            known, source = identity[start], np.full(len(names), "", object)
            count, confidence, verified = (np.zeros(len(names), np.int64) for _ in range(3))
            if self.learned.exists():
                for k, name in enumerate(names):
                    state = self.learned.getValue(name)
                    if state is not None:
                        known[k], count[k], confidence[k], verified[k], source[k] = state
            agree = identity == known[group]
            same = group[agree]
            more = np.bincount(same, minlength=len(names))
            count += more
            np.maximum.at(confidence, same, batch["confidence"].to_numpy(np.int64)[agree])
            np.maximum.at(verified, same, batch["verified"].to_numpy(np.int64)[agree])
            said = np.flatnonzero(agree & (text != ""))
            last, back = np.unique(group[said][::-1], return_index=True)
            source[last] = text[said[::-1][back]]
            latest = np.zeros(len(names), np.int64)
            latest[group] = batch["ord"].to_numpy(np.int64)  # rows stand by ord, so the last one stays
            grew = np.flatnonzero(more)
            for k in grew:
                self.learned.updateValue(names[k], (known[k], int(count[k]), int(confidence[k]), int(verified[k]), source[k]))
            values = {"identity": known, "evidence_count": count, "confidence": confidence, "verified": verified, "source": source, "ord": latest, "known_identity": known}
            learned = batch.loc[start[grew], KEYS].assign(kind="learned", **{c: x[grew] for c, x in values.items()})
            clash = batch.loc[~agree, [*KEYS, "identity", "confidence", "verified", "source", "ord"]].assign(kind="conflict", evidence_count=1, known_identity=known[group[~agree]])
            out = pd.concat([x for x in (learned, clash) if len(x)], ignore_index=True)
            yield out[[c.split()[0] for c in CHANGES.split(", ")]]

        def close(self) -> None:
            pass

    return Learner()


def alias_changes(evidence: DataFrame) -> DataFrame:
    """A stream of alias evidence (EVIDENCE) as the changes (CHANGES) that it makes; a batch reads and writes the state of its own keys only.

    The first identity that arrives for a key stays, also against a row with a smaller ord that comes later. Evidence that
    agrees counts, raises confidence and verified, and its last source that isn't empty stays; evidence that disagrees changes
    nothing and is a conflict. Needs the RocksDB state store, and a checkpoint of this form (a state for each bucket and key).
    """
    whole = evidence.select("ord", *[F.coalesce(c, F.lit("")).alias(c) for c in KEYS], "identity", F.coalesce("confidence", F.lit(0)).alias("confidence"), F.coalesce("verified", F.lit(0)).alias("verified"), F.coalesce("source", F.lit("")).alias("source"))
    dealt = whole.where(F.trim("identity") != "").withColumn("bucket", F.pmod(F.xxhash64(*KEYS), F.lit(BUCKETS)).cast("int"))
    return dealt.groupBy("bucket").transformWithStateInPandas(_learner(), outputStructType=CHANGES, outputMode="append", timeMode="none")


def learn_aliases(evidence: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Alias evidence as a stream into a table of changes; a run that starts again goes on from the checkpoint."""
    spark, key = evidence.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        return alias_changes(evidence).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    finally:
        spark.conf.set(key, before)


def current_aliases(spark: SparkSession, path: str) -> DataFrame:
    """The learned table: of each key the change with the most evidence, which is its last."""
    learned = spark.read.schema(CHANGES).parquet(path).where("kind = 'learned'")
    names = [c.split()[0] for c in STATE.split(", ")]
    return learned.groupBy(*KEYS).agg(F.max_by(F.struct(*names), "evidence_count").alias("_row")).select(*KEYS, "_row.*")


def alias_conflicts(spark: SparkSession, path: str) -> DataFrame:
    """ord, the key, known_identity and the identity that was turned down."""
    return spark.read.schema(CHANGES).parquet(path).where("kind = 'conflict'").select("ord", *KEYS, "known_identity", "identity")
