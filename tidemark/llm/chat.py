"""Chat formatting in budgeted, turn-aligned windows.

A turn becomes `<|im_start|>role<|im_sep|>text<|im_end|>` and a newline. Inside roles and texts a backslash is doubled, and
one is put into every control string (also those of other common templates), so that no control string is left in a text
and dropping each backslash that escapes a character gives the text back.

Prefix sums of the turns' tokens choose the windows: a window takes turns as long as they start in the same half stride,
and a turn longer than that stands alone. A window begins with the conversation's first system turn and up to two earlier
turns, if they fit the history's budget; these repeats are outside the loss mask, so every assistant turn is learned once.
Windows don't cross a multiple of SECTION in the turn number; with that no task ever sorts an unbounded conversation.

Built from DataFrame functions only.

Cases: null text or role: empty. Null turn: first. Null conv_id: one conversation. Repeated rows: each is a turn. A turn
over the budget: a window of its own, whole. Empty table: empty result. Further columns are not carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.scale import before, n_words

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
SECTION = 1024
#: Tokens that the template adds to a turn.
FRAME_TOKENS = 4


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, r"([<\[])(\||/?s>|/?INST\])", r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_windows(conversations: DataFrame, budget: int = 1024, history: int = 256) -> DataFrame:
    """conv_id, section, window, formatted, loss array<struct<start, length>> (code points), n_context, n_tokens.

    n_context: how many of the window's first turns are repeats.
    """
    rows = conversations.select(
        "conv_id", F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), F.col("turn").alias("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    ).withColumns({"section": F.coalesce(F.floor(F.col("turn") / SECTION), F.lit(-(1 << 40))).cast("long"), "tokens": n_words(F.col("text")) + n_words(F.col("role")) + FRAME_TOKENS})
    rows = rows.withColumn("null_id", F.col("conv_id").isNull())
    part, order = ["conv", "null_id", "section"], [F.col("turn").asc_nulls_first(), "role", "text"]
    w = Window.partitionBy(*part).orderBy(*order)
    rows = rows.withColumns({"start": before(F.col("tokens"), part, order), "at": F.row_number().over(w)})
    first_system = F.min(F.when(F.col("role") == "system", F.struct("section", "at", "role", "text", "tokens")))
    systems = rows.where(F.col("role") == "system").groupBy("conv", "null_id").agg(first_system.alias("system"))
    rows = rows.join(systems, ["conv", "null_id"], "left")
    half = F.greatest(F.lit(16).cast("long"), (F.lit(budget - history) - F.coalesce(F.col("system.tokens"), F.lit(0))) / 2)
    rows = rows.withColumns({"stride": F.floor(F.col("start") / half), "alone": F.col("tokens") > half})
    opens = F.lag("at", 1).over(w).isNull() | F.col("alone") | F.lag("alone", 1).over(w) | (F.lag("stride", 1).over(w) != F.col("stride"))
    rows = rows.withColumn("opens", opens.cast("int")).withColumn("window", F.sum("opens").over(w))
    rows = rows.withColumns({"next1": F.lead("window", 1).over(w), "next2": F.lead("window", 2).over(w), "tokens1": F.lead("tokens", 1).over(w)})
    place = lambda window, again: F.struct(window.alias("window"), F.lit(again).alias("again"))
    places = F.array(
        place(F.col("window"), False),
        F.when((F.col("next1") != F.col("window")) & (F.col("tokens") <= history), place(F.col("next1"), True)),
        F.when((F.col("next2") != F.col("window")) & (F.col("next2") != F.col("next1")) & (F.col("tokens") + F.col("tokens1") <= history), place(F.col("next2"), True)),
    )
    placed = rows.select("conv_id", *part, "system", "at", "role", "text", "tokens", F.explode(F.array_compact(places)).alias("p"))
    turn = F.struct(F.col("at"), F.col("p.again").alias("again"), F.col("role"), F.col("text"), F.col("tokens"))
    windows = placed.groupBy(*part, F.col("p.window").alias("window")).agg(F.first("conv_id").alias("conv_id"), F.first("system").alias("system"), F.sort_array(F.collect_list(turn)).alias("turns"))
    has_system = F.col("system").isNull() | ((F.col("system.section") == F.col("section")) & F.exists("turns", lambda t: t["at"] == F.col("system.at")))
    lead = F.array(F.struct(F.lit(0).alias("at"), F.lit(True).alias("again"), F.col("system.role").alias("role"), F.col("system.text").alias("text"), F.col("system.tokens").alias("tokens")))
    windows = windows.withColumn("turns", F.when(has_system, F.col("turns")).otherwise(F.concat(lead, F.col("turns"))))
    piece = lambda t: F.struct(F.concat(F.lit(START), escape(t["role"]), F.lit(SEP)).alias("head"), escape(t["text"]).alias("body"), (~t["again"] & (t["role"] == "assistant")).alias("learn"))
    windows = windows.withColumn("pieces", F.transform("turns", piece))

    def span(s: Column, x: Column) -> Column:
        body = s["end"] + F.length(x["head"])
        loss = F.when(x["learn"], F.concat(s["loss"], F.array(F.struct(body.alias("start"), F.length(x["body"]).alias("length"))))).otherwise(s["loss"])
        return F.struct((body + F.length(x["body"]) + len(END)).alias("end"), loss.alias("loss"))

    none = F.array().cast("array<struct<start:int,length:int>>")
    loss = F.aggregate("pieces", F.struct(F.lit(0).alias("end"), none.alias("loss")), span)["loss"]
    formatted = F.array_join(F.transform("pieces", lambda x: F.concat(x["head"], x["body"], F.lit(END))), "")
    total = F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + t["tokens"])
    return windows.select("conv_id", "section", "window", formatted.alias("formatted"), loss.alias("loss"), F.size(F.filter("turns", lambda t: t["again"])).alias("n_context"), total.alias("n_tokens"))


def read_back(windows: DataFrame) -> DataFrame:
    """The windows with `turns` (array of role and text, without repeats) and `learned` (texts under the mask), read from formatted."""
    ended = F.filter(F.split("formatted", r"<\|im_end\|>\n"), lambda x: x != "")
    bare = F.transform(F.slice(ended, F.col("n_context") + 1, F.greatest(F.size(ended), F.lit(1))), lambda x: F.split(F.substr(x, F.lit(len(START) + 1)), r"<\|im_sep\|>"))
    turns = F.transform(bare, lambda x: F.struct(unescape(x[0]).alias("role"), unescape(x[1]).alias("text")))
    learned = F.transform("loss", lambda x: unescape(F.substr(F.col("formatted"), x["start"] + 1, x["length"])))
    return windows.withColumns({"turns": turns, "learned": learned})


def digests(windows: DataFrame) -> DataFrame:
    """One row for each conversation, of what read_back finds in its windows."""
    back = read_back(windows)
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    back = back.select("conv_id", F.struct("section", "window", turns.alias("turns"), F.array_join("learned", "").alias("learned")).alias("x"), F.size("turns").alias("n"), F.length("formatted").alias("chars"))
    whole = back.groupBy("conv_id").agg(F.sort_array(F.collect_list("x")).alias("xs"), F.sum("n").cast("long").alias("n_turns"), F.sum("chars").cast("long").alias("formatted_chars"))
    whole = whole.withColumns({"all": F.array_join(F.transform("xs", lambda x: x["turns"]), ""), "learned": F.array_join(F.transform("xs", lambda x: x["learned"]), "")})
    return whole.select("conv_id", "n_turns", F.sha2("all", 256).alias("turns_sha256"), F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"), "formatted_chars")
