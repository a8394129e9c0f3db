"""People as they arrive from several sources: one person for all rows that an identity links.

Rows are linked where they share a tmdb id or an imdb id; these links make a graph of rows and ids, and its components are the
people. A person that only credits speak of has no ids to meet a known one by, so it joins by name: the person of that name
with the lowest number, or else the first credit of that name.

Components come from labels: each row starts with its own place; in a round a key takes the least label of its rows, a row
the least of its keys, and then the label of the row that its label names (so long chains halve). Both steps are minima that
are taken in the tasks first, so a key that a third of all rows share is no large group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import filled, nonempty, normalize_name
from tidemark.session import saved

#: Columns of stored people and of arrivals.
STORED = "person_id bigint, tmdb_id bigint, imdb_id string, name string, extra string"
ARRIVALS = "ord bigint, path string, tmdb_id bigint, imdb_id string, name string, extra string"


def components(links: DataFrame) -> DataFrame:
    """node, label: the smallest node of its component. links: node, key (nodes with a common key are linked; a null key links nothing)."""
    links = links.select("node", "key").distinct()
    edges = saved(links.where(F.col("key").isNotNull()), "links")
    labels = links.select("node").distinct().withColumn("label", F.col("node"))
    while True:
        least = edges.join(labels, "node").groupBy("key").agg(F.min("label").alias("least"))
        met = edges.join(least, "key").groupBy("node").agg(F.min("least").alias("met"))
        moved = saved(labels.join(met, "node", "left").select("node", "label", F.least("label", "met").alias("next")), "labels")
        if moved.where(F.col("next") < F.col("label")).isEmpty():
            return moved.select("node", "label")
        far = moved.select(F.col("node").alias("next"), F.col("next").alias("further"))
        labels = moved.join(far, "next", "left").select("node", F.least("next", "further").alias("label"))


def imdb_key(c: Column) -> Column:
    """An imdb id as text, or null: tt and digits, in any case, with blanks around."""
    return nonempty(F.regexp_extract(F.lower(F.trim(filled(c))), r"^(tt\d+)$", 1))


def _rows(stored: DataFrame, arrivals: DataFrame) -> DataFrame:
    """All rows under one number, stored ones first: node, person_id (null for arrivals), path, the ids and texts."""
    known = stored.select(F.struct(F.lit(0).alias("late"), F.col("person_id").alias("at")).alias("node"), "person_id", F.lit("stored").alias("path"), "tmdb_id", "imdb_id", "name", "extra")
    new = arrivals.select(F.struct(F.lit(1).alias("late"), F.col("ord").alias("at")).alias("node"), F.lit(None).cast("bigint").alias("person_id"), "path", "tmdb_id", F.when(F.col("path") != "credits", F.col("imdb_id")).alias("imdb_id"), "name", "extra")
    rows = known.unionByName(new).withColumns({"imdb_id": imdb_key(F.col("imdb_id")), "name": nonempty(F.trim(filled(F.col("name"))))})
    rows = rows.withColumn("norm", nonempty(normalize_name(F.coalesce("name", F.lit("")))))
    named = F.when(F.col("path") == "credits", F.col("name").isNotNull()).otherwise(F.col("name").isNotNull() | F.col("tmdb_id").isNotNull() | F.col("imdb_id").isNotNull())
    return rows.where(named | (F.col("path") == "stored"))


def link_people(stored: DataFrame, arrivals: DataFrame) -> DataFrame:
    """The rows of both tables that say whom they mean, with `person`: the node (late, at) that stands for the person.

    stored: STORED. arrivals: ARRIVALS, path `metadata` (ids count; a name alone is always a new person) or `credits` (the tmdb
    id counts, else the name; rows without a name are left out).
    """
    rows = saved(_rows(stored, arrivals), "people")
    ids = F.explode(F.array(F.concat(F.lit("tmdb:"), F.col("tmdb_id").cast("string")), F.concat(F.lit("imdb:"), F.col("imdb_id"))))
    by_id = components(rows.select("node", ids.alias("key")))
    rows = saved(rows.join(by_id, "node"), "people")
    # people that only credits speak of, and for each name the person that it means
    loose = rows.groupBy("label").agg(F.bool_and(F.col("path") == "credits").alias("loose"))
    rows = rows.join(loose, "label")
    owner = rows.where(F.col("norm").isNotNull()).groupBy("norm").agg(F.min(F.struct("loose", "label"))["label"].alias("owner"))
    links = rows.where("loose").groupBy("label").agg(F.min_by("norm", F.when(F.col("norm").isNotNull(), F.col("node"))).alias("norm")).join(owner, "norm")
    named = F.concat_ws(":", F.col("owner.late").cast("string"), F.col("owner.at").cast("string"))
    to_name = links.select(F.col("label").alias("node"), named.alias("key")).unionByName(links.select(F.col("owner").alias("node"), named.alias("key")))
    joined = components(to_name).select(F.col("node").alias("label"), F.col("label").alias("by_name"))
    return saved(rows.join(joined, "label", "left").withColumn("person", F.coalesce("by_name", "label")).drop("label", "by_name", "loose"), "people")


def upsert_people(stored: DataFrame, arrivals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The people after the arrivals (STORED), and for each arrival its person (ord, person_id).

    The lowest stored number stays; a new person's number is the highest stored one, plus one, plus the ord of its first arrival (0 or more). The last imdb id,
    name and extra that aren't empty stand. A tmdb id is replaced by one that metadata bring; credits only fill a missing one.
    """
    rows = link_people(stored, arrivals)
    highest = stored.agg(F.coalesce(F.max("person_id"), F.lit(0))).first()[0]
    number = F.coalesce(F.min("person_id"), F.lit(highest + 1) + F.min(F.when(F.col("node.late") == 1, F.col("node.at"))))
    last = lambda c, ok=F.lit(True): F.max_by(c, F.when(F.col(c).isNotNull() & ok, F.col("node")))
    first_credit = F.min_by("tmdb_id", F.when(F.col("tmdb_id").isNotNull() & (F.col("path") == "credits"), F.col("node")))
    extra = F.when(~filled(F.col("extra")).isin("", "{}"), F.col("extra"))
    people = rows.withColumn("extra", extra).groupBy("person").agg(
        number.alias("person_id"), F.coalesce(last("tmdb_id", F.col("path") != "credits"), first_credit).alias("tmdb_id"), F.coalesce(last("imdb_id"), F.lit("")).alias("imdb_id"),
        F.coalesce(last("name"), F.lit("")).alias("name"), F.coalesce(last("extra"), F.lit("{}")).alias("extra"),
    )
    of = rows.where(F.col("node.late") == 1).select(F.col("node.at").alias("ord"), "person").join(people.select("person", "person_id"), "person")
    return people.drop("person"), of.select("ord", "person_id")


def replaced_numbers(stored: DataFrame, linked: DataFrame) -> DataFrame:
    """person_id, kept_id of stored people that turned out to be one with another: credits under the old number move. linked: link_people's rows."""
    of = linked.where(F.col("person_id").isNotNull()).groupBy("person").agg(F.min("person_id").alias("kept_id"))
    return linked.join(of, "person").where(F.col("person_id") > F.col("kept_id")).select("person_id", "kept_id")
