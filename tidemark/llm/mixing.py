"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source's documents are dealt at random into blocks, each a fixed share of the source. A pass over a source is a random
permutation of its blocks. A source's quota is the exact number of block draws that its target takes: all blocks of its
whole passes, and of one more pass as many as it takes to reach the target in words. The tree halves the output shards again
and again and, at each node, draws without replacement how many of every source's blocks go left, so each shard gets its
share of draws and every quota is used up exactly. A source's draws, pass after pass in permuted order, are then dealt to
the shards by the numbers at the tree's leaves: disjoint runs of permuted blocks. A document is in the mixture as often as
its block is in a run; the block that ends the quota is cut, so a source's words meet its target. Each shard is shuffled by
itself.

Built from DataFrame functions only. The texts are read once for a narrow table of sizes and keys; all else works on that
table, on one row for each block (at most MOST_BLOCKS a source), and on one row a source. The tree holds all sources in one
row and takes tables of up to some ten thousand sources.

Cases: null text or no word: size 0, drawn with its block, adds no word; in a source without any word, each document is
drawn once. Null source: a source of its own, last. Repeated rows: each counts for itself; those that the cut meets are cut
alike. Empty table: empty result. Further columns are carried along by `mix`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.scale import let, materialize, n_words

WEIGHTS = (5.0, 2.0, 1.0)
MOST_REPEATS = 3
MOST_BLOCKS = 1 << 14
N_SHARDS, SEED = 16, 11
#: Words of a part of a shard that a task shuffles.
PART_WORDS = 1 << 24


def _uniform(*cols: Column) -> Column:
    """A number in [0, 1) fixed by the columns."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / float(1 << 53)


def hypergeometric(seed: Column, total: Column, good: Column, draws: Column) -> Column:
    """How many of `good` marked items are among `draws` out of `total`; seed (a 64-bit number) decides.

    The terms of the distribution are walked outward from its mode, first up and then down, 14 standard deviations to either
    side (all of it, in double precision), by the ratio of neighbouring terms. Each term takes the place of the pick so far
    with its share of the sum up to it, so the last pick has the distribution without its sum being known beforehand.
    """
    zero, long = F.lit(0).cast("long"), lambda c: c.cast("long")
    total, good, draws = long(total), long(good), long(draws)
    mode = F.floor((draws + 1).cast("double") * (good + 1) / (total + 2)).cast("long")
    var = draws * (good / total) * (1 - good / total) * (total - draws) / F.greatest(total - 1, F.lit(1))
    width = (F.ceil(14 * F.sqrt(F.greatest(F.coalesce(var, F.lit(0.0)), F.lit(0.0)))) + 14).cast("long")
    asked = F.struct(total.alias("total"), good.alias("good"), draws.alias("draws"), F.greatest(zero, draws - total + good).alias("lo"), F.least(draws, good).alias("hi"), mode.alias("near"), width.alias("width"), seed.alias("seed"))

    def drawn(x: Column) -> Column:
        mode = F.least(x["hi"], F.greatest(x["lo"], x["near"]))
        span = lambda to: F.when(to > 0, F.sequence(F.lit(1).cast("long"), to)).otherwise(F.array().cast("array<bigint>"))
        up, down = F.least(x["hi"] - mode, x["width"]), F.least(mode - x["lo"], x["width"])
        spare = x["total"] - x["good"] - x["draws"]

        def step(s: Column, j: Column) -> Column:
            k = mode + j
            rise = (x["good"] - k + 1).cast("double") * (x["draws"] - k + 1) / (k.cast("double") * (spare + k))
            fall = (k + 1).cast("double") * (spare + k + 1) / ((x["good"] - k).cast("double") * (x["draws"] - k))
            p = F.when(F.abs(j) == 1, 1.0).otherwise(s["p"]) * F.when(j > 0, rise).otherwise(fall)
            pick = F.when(_uniform(x["seed"], j) * (s["sum"] + p) < p, k).otherwise(s["pick"])
            return F.struct(p.alias("p"), (s["sum"] + p).alias("sum"), pick.alias("pick"))

        ways = F.concat(span(up), F.transform(span(down), lambda j: -j))
        return F.aggregate(ways, F.struct(F.lit(1.0).alias("p"), F.lit(1.0).alias("sum"), mode.alias("pick")), step)["pick"]

    return let(asked, drawn)


def targets(sources: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """source, source_size -> idx, weight, target.

    Sources by code point, null last, get the weights in turn. A target is the source's share of all words by weight, at
    most `most` times what it holds; what is cut off goes to the others by weight. So all targets that aren't cut are one
    level times their weight, and the cut ones are those with the least room per weight.
    """
    everything = Window.partitionBy()
    ranked = sources.withColumn("idx", (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).cast("int"))
    wide = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("idx") % len(weights) + 1).cast("int"))).withColumn("room", (F.col("source_size") * most).cast("double"))
    by_room = Window.orderBy((F.col("room") / F.col("weight")).asc(), F.col("idx").asc())
    earlier = by_room.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("room").over(earlier), F.lit(0.0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)))
    cut = wide.withColumn("fits", (F.col("room") > level * F.col("weight")).cast("int"))
    cut = cut.withColumn("cut", F.max("fits").over(by_room.rowsBetween(Window.unboundedPreceding, 0)) == 0)
    rest = (F.sum("source_size").over(everything) - F.sum(F.when(F.col("cut"), F.col("room")).otherwise(0.0)).over(everything)) / F.sum(F.when(F.col("cut"), 0.0).otherwise(F.col("weight"))).over(everything)
    return cut.withColumn("target", F.when(F.col("cut"), F.col("room")).otherwise(rest * F.col("weight"))).select("source", "source_size", "idx", "weight", "target")


def _split_tree(quotas: DataFrame, n_shards: int, seed: int) -> DataFrame:
    """idx, blocks -> idx, bounds: how many of the source's dealt blocks shards 0..s hold, for every s.

    One row holds a node: its first shard, how many shards, and the quotas of all sources in order. At each level a node
    with more than one shard becomes two; source after source, its blocks going left are drawn from what is still open.
    """
    tree = quotas.agg(F.transform(F.array_sort(F.collect_list(F.struct("idx", "blocks"))), lambda x: x["blocks"]).alias("q"), F.transform(F.array_sort(F.collect_list(F.struct("idx", "blocks"))), lambda x: x["idx"]).alias("ids"))
    tree = tree.select(F.lit(0).alias("first"), F.lit(n_shards).alias("many"), "q", "ids")
    half = F.floor(F.col("many") / 2).cast("int")

    def deal_left(s: Column, x: Column) -> Column:
        k = F.when(x == 0, F.lit(0).cast("long")).when(s["open"] == x, s["draws"]).when(s["draws"] == 0, F.lit(0).cast("long"))
        k = k.otherwise(hypergeometric(F.xxhash64(F.lit(seed), F.col("first"), F.col("many"), F.size(s["left"])), s["open"], x, s["draws"]))
        return F.struct((s["open"] - x).alias("open"), (s["draws"] - k).alias("draws"), F.concat(s["left"], F.array(k)).alias("left"))

    start = F.struct(F.col("total").alias("open"), F.round(F.col("total") * half / F.col("many")).cast("long").alias("draws"), F.array().cast("array<bigint>").alias("left"))
    left = F.when(F.col("many") > 1, F.aggregate("q", start, deal_left)["left"]).otherwise(F.col("q"))
    kept = F.when(F.col("many") > 1, half).otherwise(F.col("many"))
    nodes = F.array(
        F.struct(F.col("first").alias("first"), kept.alias("many"), F.col("left").alias("q")),
        F.struct((F.col("first") + kept).alias("first"), (F.col("many") - kept).alias("many"), F.zip_with("q", "left", lambda a, b: a - b).alias("q")),
    )
    nodes, total = F.filter(nodes, lambda x: x["many"] > 0), F.aggregate("q", F.lit(0).cast("long"), lambda a, x: a + x)
    for _ in range(max(0, (n_shards - 1).bit_length())):
        tree = tree.withColumn("total", total).withColumn("left", left).select("ids", F.explode(nodes).alias("x")).select("x.first", "x.many", "x.q", "ids")
    by_shard = tree.select(F.col("first").alias("shard"), F.posexplode(F.arrays_zip("ids", "q")).alias("pos", "x")).select("shard", "x.ids", "x.q")
    return by_shard.groupBy(F.col("ids").alias("idx")).agg(F.transform(F.array_sort(F.collect_list(F.struct("shard", "q"))), lambda x: x["q"]).alias("q")).select("idx", F.transform("q", lambda _, i: F.aggregate(F.slice("q", F.lit(1), i + 1), F.lit(0).cast("long"), lambda a, x: a + x)).alias("bounds"))


def blocks_for(n_rows: int) -> int:
    """Into how many blocks each source is dealt: about as many as a block of the whole table has rows."""
    return max(16, min(MOST_BLOCKS, math.isqrt(n_rows)))


def measure(docs: DataFrame, blocks: int, seed: int = SEED) -> DataFrame:
    """_row (all columns of docs but text), text, source, _mix_size (words), _mix_key (a random number fixed by doc_id and text), _mix_block."""
    row = F.struct(*[c for c in docs.columns if c != "text"])
    keyed = docs.select(row.alias("_row"), "text", "source", n_words(F.col("text")).alias("_mix_size"), F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")).alias("_mix_key"))
    return keyed.withColumn("_mix_block", F.pmod(F.xxhash64(F.lit(seed + 1), F.col("_mix_key")), F.lit(blocks)).cast("int"))


def quotas(measured: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_REPEATS, n_shards: int = N_SHARDS, seed: int = SEED) -> DataFrame:
    """source, block, source_size, target, cut_key, cut_words, draws: array<struct<pass, number, shard, cut>>, for every block of measured.

    cut says that the draw ends its source's quota: of its block, in the order of the keys, documents before cut_key are
    taken, and cut_words words of that one.
    """
    long = lambda c: c.cast("long")
    blocks = materialize(measured.groupBy("source", F.col("_mix_block").alias("block")).agg(F.sum("_mix_size").alias("words")), "mix-blocks")
    totals = blocks.groupBy("source").agg(F.sum("words").alias("source_size"), F.count("*").alias("n_blocks"))
    aimed = targets(totals.select("source", "source_size"), weights, most).join(totals.select(F.col("source").alias("of"), "n_blocks"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    whole = F.when(F.col("source_size") > 0, F.least(F.lit(most).cast("double"), F.floor(F.col("target") / F.col("source_size")))).otherwise(1)
    aimed = aimed.withColumn("passes", long(whole))
    aimed = materialize(aimed.withColumn("rest", F.when(F.col("passes") < most, F.greatest(F.lit(0).cast("long"), long(F.round(F.col("target"))) - F.col("passes") * F.col("source_size"))).otherwise(0)), "mix-targets")
    about = aimed.select(F.col("source").alias("of"), "idx", "source_size", "target", "n_blocks", "passes", "rest")
    named = blocks.join(about, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    permuted = lambda p: Window.partitionBy("idx").orderBy(F.xxhash64(F.lit(seed), p, F.col("block")), "block")
    place = [long(F.row_number().over(permuted(long(F.lit(p)))) - 1).alias(f"p{p}") for p in range(most)]
    last = permuted(F.col("passes"))
    ranked = named.select("*", *place, F.coalesce(F.sum("words").over(last.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    # the draw of a whole pass, and where the block stands in the pass after the whole ones
    numbers = F.array(*[F.when(F.col("passes") > p, p * F.col("n_blocks") + F.col(f"p{p}")) for p in range(most)])
    after = F.element_at(F.array(*[F.col(f"p{p}") for p in range(most)], F.lit(0).cast("long")), (F.col("passes") + 1).cast("int"))
    ranked = materialize(ranked.select("source", "idx", "block", "words", "source_size", "target", "n_blocks", "passes", "rest", "before", numbers.alias("numbers"), (F.col("passes") * F.col("n_blocks") + after).alias("last")), "mix-ranked")
    asked = ranked.groupBy("idx").agg(long(F.max(F.col("passes") * F.col("n_blocks")) + F.count_if((F.col("rest") > 0) & (F.col("before") < F.col("rest")))).alias("blocks"))
    tree = materialize(_split_tree(asked, n_shards, seed), "mix-tree")
    # the block that ends the quota, and where in it
    ends = ranked.where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") > F.col("rest"))).select(F.col("source").alias("of"), "block", "idx", (F.col("rest") - F.col("before")).alias("room"))
    inside = measured.join(ends, F.col("source").eqNullSafe(F.col("of")) & (F.col("_mix_block") == F.col("block"))).groupBy("idx", "room", "_mix_key").agg(F.sum("_mix_size").alias("words"), F.count("*").alias("n"))
    inside = inside.withColumn("before", F.coalesce(F.sum("words").over(Window.partitionBy("idx").orderBy("_mix_key").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    met = (F.col("before") <= F.col("room")) & (F.col("before") + F.col("words") > F.col("room"))
    cuts = inside.where(met).select(F.col("idx").alias("cut_idx"), F.col("_mix_key").alias("cut_key"), F.floor((F.col("room") - F.col("before")) / F.col("n")).cast("long").alias("cut_words"))
    out = ranked.join(tree, "idx").join(cuts, F.col("idx") == F.col("cut_idx"), "left")
    ending = F.col("before") + F.col("words") > F.col("rest")

    def draw(p: Column, number: Column, cut: Column) -> Column:
        return F.struct(p.cast("int").alias("pass"), number.alias("number"), F.size(F.filter("bounds", lambda b: b <= number)).alias("shard"), cut.alias("cut"))

    repeated = F.transform(F.filter(F.transform("numbers", lambda x, p: F.struct(x.alias("x"), p.alias("p"))), lambda s: s["x"].isNotNull()), lambda s: draw(s["p"], s["x"], F.lit(False)))
    # a draw is in the mixture if the tree has dealt its number to a shard
    draws = F.filter(F.concat(repeated, F.array(draw(F.col("passes"), F.col("last"), ending))), lambda d: d["shard"] < n_shards)
    return materialize(out.select("source", "block", "source_size", "target", "cut_key", "cut_words", draws.alias("draws")), "mix-draws")


def deal(measured: DataFrame, dealt: DataFrame, whole: bool = False) -> DataFrame:
    """measured with `_mix`: struct<size, source_size, target, draws: array<struct<pass, words, block, number, shard>>>.

    A draw takes the first `words` words of the document. Only the document at the end of a source's quota is cut, or, with
    whole=True, taken whole if more than half of it fits and else left out.
    """
    to = dealt.withColumnsRenamed({"source": "_mix_of", "block": "_mix_at"})
    d = measured.join(to, F.col("source").eqNullSafe(F.col("_mix_of")) & (F.col("_mix_block") == F.col("_mix_at")))
    size, key = F.col("_mix_size"), F.col("_mix_key")
    part = F.when(F.col("cut_words") * 2 > size, size) if whole else F.when(F.col("cut_words") > 0, F.col("cut_words"))
    words = F.when(key < F.col("cut_key"), size).when(key == F.col("cut_key"), part)
    drawn = F.transform("draws", lambda x: F.struct(x["pass"].alias("pass"), F.when(x["cut"], words).otherwise(size).alias("words"), F.col("_mix_at").alias("block"), x["number"].alias("number"), x["shard"].alias("shard")))
    mix_ = F.struct(size.alias("size"), "source_size", "target", F.filter(drawn, lambda x: x["words"].isNotNull()).alias("draws"))
    columns = [c for c in measured.columns if c not in ("_mix_size", "_mix_block")]
    return d.select(*columns, mix_.alias("_mix"))


def plan(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_REPEATS, n_shards: int = N_SHARDS, blocks: int | None = None, seed: int = SEED, whole: bool = False) -> DataFrame:
    """_row (each row of docs without its text), with `_mix` as `deal` gives it."""
    narrow = materialize(measure(docs, blocks or blocks_for(docs.count()), seed).drop("text"), "mix-sizes")
    return deal(narrow, quotas(narrow, weights, most, n_shards, seed), whole).select("_row", "_mix")


def mix(docs: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_REPEATS, n_shards: int = N_SHARDS, blocks: int | None = None, seed: int = SEED, whole: bool = False, part_words: int = PART_WORDS) -> DataFrame:
    """The mixture: one row for each draw, with the columns of docs, then mix_shard, mix_part, mix_pass and mix_words (words to read).

    Shards are laid out one by one and each is shuffled by itself. A large shard is dealt at random into parts, which are
    shuffled in tasks of their own; the number of parts follows the words of the mixture.
    """
    measured = measure(docs, blocks or blocks_for(docs.count()), seed)
    narrow = materialize(measured.select("source", "_mix_size", "_mix_key", "_mix_block"), "mix-sizes")
    dealt = quotas(narrow, weights, most, n_shards, seed)
    words = narrow.agg(F.sum("_mix_size")).first()[0] or 0
    parts = max(1, -(-words // (n_shards * part_words)))
    added = ("mix_shard", "mix_part", "mix_pass", "mix_words")
    columns = [(F.col("text") if c == "text" else F.col("_row").getField(c)).alias(c) for c in docs.columns if c not in added]
    out = deal(measured, dealt, whole).select("_row", "text", "_mix_key", F.explode("_mix.draws").alias("_draw"))
    order = F.xxhash64(F.lit(seed + 2), F.col("_mix_key"), F.col("_draw.pass"))
    out = out.withColumns({"_mix_order": order, "_mix_shard": F.col("_draw.shard"), "_mix_part": F.pmod(order, F.lit(parts)).cast("int")})
    out = out.repartition("_mix_shard", "_mix_part").sortWithinPartitions("_mix_shard", "_mix_part", "_mix_order")
    return out.select(*columns, F.col("_mix_shard").alias("mix_shard"), F.col("_mix_part").alias("mix_part"), F.col("_draw.pass").alias("mix_pass"), F.col("_draw.words").alias("mix_words"))
