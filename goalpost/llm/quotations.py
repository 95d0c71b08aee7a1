"""Quotation linking: quoted passages are joined to the messages they quote, which orders a conversation by replies.

A line that starts with one or more ``>`` (blanks between and before them allowed) is quoted at that depth; adjacent
lines of one depth are a passage.  Passages and lines are normalised (lower case, single blanks, trimmed) and hashed.
A hash links to the earliest turn of the same conversation that says it itself, if that turn is before the quoting one.
A message replies to the latest turn it quotes at depth 1, else to the turn before it.  A reply to any turn but the one
before starts a branch, which is read after the turn it answers and everything that follows that turn; the result has
each message's place in that order and its text without quotes.

Only DataFrame functions run on the data.  Originals are aggregated by (conversation, hash) before the join, so a line
said thousands of times is one row; running values go by blocks of turns, so a conversation is never one group.

Defined results: a null text has no line and the text without quotes ''; a null conversation is a conversation, a null
turn comes before all turns; repeated (conversation, turn) rows are one turn with all their lines, one result row each
and one place after the other; quotes of unknown origin link to nothing and are still left out; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goalpost.llm.common import saved
from goalpost.operators.ranking import row_number_within

BLOCK = 1024
_QUOTE = r"^((?:[ \t]*>)+)[ \t]?(.*)$"


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def lines_of(text: Column) -> Column:
    """(depth, body) of every line, in order."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(x, _QUOTE, 1), r"[^>]", "")).alias("depth"),
        F.when(F.regexp_like(x, F.lit(_QUOTE)), F.regexp_extract(x, _QUOTE, 2)).otherwise(x).alias("body")))


def own_text(text: Column) -> Column:
    """The text without its quoted lines."""
    kept = F.filter(lines_of(text), lambda x: x["depth"] == 0)
    return F.trim(F.array_join(F.transform(kept, lambda x: x["body"]), "\n"))


def _passages(text: Column) -> Column:
    """(depth, body) of every quoted passage: adjacent lines of one depth, joined."""
    kind = "array<struct<depth:int,body:string>>"
    return F.filter(F.aggregate(
        lines_of(text), F.array().cast(kind),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["depth"] == x["depth"]),
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.struct(
                x["depth"].alias("depth"),
                F.concat_ws("\n", F.try_element_at(done, F.lit(-1))["body"], x["body"]).alias("body")))))
        .otherwise(F.concat(done, F.array(x))).cast(kind)), lambda p: p["depth"] > 0)


def _hash(text: Column) -> Column:
    return F.md5(normalised(text).cast("binary"))


def _pieces(body: Column) -> Column:
    """Hashes of a passage as a whole and of each of its lines; blank ones are left out."""
    return F.transform(F.filter(F.array_distinct(F.concat(F.array(body), F.split(body, "\n"))),
                                lambda x: normalised(x) != ""), lambda x: _hash(x))


def links(messages: DataFrame) -> DataFrame:
    """(conv, turn, depth, passage, origin): quoted passages and the earlier turn that said them first, or null."""
    rows = messages.select("conv", "turn", "text")
    quoted = (rows.where(F.contains("text", F.lit(">")))
                  .select("conv", "turn", F.posexplode(_passages(F.col("text"))).alias("p", "quote"))
                  .select("conv", "turn", F.col("quote.depth").alias("depth"), _hash(F.col("quote.body")).alias("passage"),
                          F.explode_outer(_pieces(F.col("quote.body"))).alias("hash")))
    quoted = saved(quoted.distinct(), "quoted")
    convs = quoted.select("conv").distinct()
    said = (rows.join(convs, F.expr("true") & rows["conv"].eqNullSafe(convs["conv"]), "left_semi")
                .select("conv", "turn", F.explode(_pieces(own_text(F.col("text")))).alias("hash"))
                .groupBy("conv", "hash").agg(F.min("turn").alias("origin")))
    said = said.withColumnRenamed("conv", "said_conv").withColumnRenamed("hash", "said_hash")
    found = quoted.join(said, (quoted["hash"] == said["said_hash"]) & quoted["conv"].eqNullSafe(said["said_conv"])
                        & (said["origin"] < quoted["turn"]), "left")
    # the whole passage's origin, else the latest of its lines' origins
    whole = F.max(F.when(F.col("hash") == F.col("passage"), F.col("origin")))
    return found.groupBy("conv", "turn", "depth", "passage").agg(
        F.coalesce(whole, F.max("origin")).alias("origin"))


def running_max(rows: DataFrame, value: str, name: str) -> DataFrame:
    """``name``: the largest ``value`` of the conversation's earlier turns, by blocks of turns and then over blocks."""
    inside = Window.partitionBy("conv", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv", "block").agg(F.max(value).alias("most"))
    over = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.withColumn("most", F.max("most").over(over)).select(
        F.col("conv").alias("bc"), F.col("block").alias("bb"), "most")
    return (rows.withColumn("near", F.max(value).over(inside))
                .join(before, F.col("conv").eqNullSafe(F.col("bc")) & (F.col("block") == F.col("bb")))
                .withColumn(name, F.greatest("near", "most")).drop("near", "most", "bc", "bb"))


def order(conversations: DataFrame) -> DataFrame:
    """Every message with its parent, branch, place in reply order, quote counts and text without quotes."""
    null_turn = F.lit(-(1 << 62))
    base = saved(conversations.select(
        conversations["conv_id"].alias("conv"), F.coalesce(conversations["turn"].cast("long"), null_turn).alias("turn"),
        conversations["role"].alias("role"), conversations["text"].alias("text")), "messages")
    quotes = saved(links(base), "quote-links")
    per_turn = quotes.groupBy("conv", "turn").agg(
        F.count(F.lit(1)).alias("n_quotes"), F.count("origin").alias("n_linked"), F.max("depth").alias("quote_depth"),
        F.max(F.when(F.col("depth") == 1, F.col("origin"))).alias("answers"))
    turns = base.select("conv", "turn").distinct().withColumn("block", F.floor(F.col("turn") / BLOCK))
    turns = running_max(turns, "turn", "previous")
    q = per_turn.select(F.col("conv").alias("qc"), F.col("turn").alias("qt"), "n_quotes", "n_linked", "quote_depth",
                        "answers")
    turns = saved(turns.join(q, F.col("conv").eqNullSafe(F.col("qc")) & (F.col("turn") == F.col("qt")), "left")
                       .withColumn("starts", F.when(F.col("answers") < F.col("previous"), F.col("turn"))), "turns")
    turns = running_max(turns, "starts", "begun").withColumn("branch", F.coalesce("starts", "begun"))
    paths = _paths(turns)
    turns = (turns.join(paths, F.col("conv").eqNullSafe(F.col("pc")) & F.col("branch").eqNullSafe(F.col("pb")), "left")
                  .withColumn("path", F.coalesce("path", F.array().cast("array<string>")))
                  .select(F.col("conv").alias("tc"), F.col("turn").alias("tt"), "previous", "branch", "path", "answers",
                          "n_quotes", "n_linked", "quote_depth"))
    placed = base.join(turns, F.col("conv").eqNullSafe(F.col("tc")) & (F.col("turn") == F.col("tt")))
    placed = placed.withColumn("own_text", own_text(F.col("text"))).drop("text", "tc", "tt")
    # reply order: a branch's path, then the turn; equal turns by role and text
    spot = F.concat_ws("/", "path").alias("spot")
    placed = row_number_within(
        placed.withColumn("spot", spot).drop("path"), ["conv"],
        [F.col("spot"), F.col("turn"), F.col("role"), F.col("own_text")], "place")
    real = lambda c: F.when(F.col(c) != null_turn, F.col(c))
    return placed.select(
        F.col("conv").alias("conv_id"), real("turn").alias("turn"), "role", "place",
        F.coalesce("answers", real("previous")).alias("parent_turn"), real("branch").alias("branch"),
        F.coalesce("n_quotes", F.lit(0)).cast("long").alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
        F.coalesce("quote_depth", F.lit(0)).cast("long").alias("quote_depth"), F.col("own_text").alias("text"))


def _paths(turns: DataFrame) -> DataFrame:
    """(pc, pb, path): sort keys of every branch, its own step after those of the branches it hangs on.

    Steps join by pointer doubling, so the rounds are the logarithm of the deepest nesting.  A step is the answered
    turn, later ones first, then the branch's first turn; a branch comes after its parent's turns because the parent's
    path is a prefix and the step sorts behind."""
    wide = lambda c: F.lpad(c.cast("string"), 20, "0")
    heads = turns.where("starts IS NOT NULL").select("conv", "starts", "answers")
    step = F.concat(wide(F.lit((1 << 62) - 1) - F.col("answers")), F.lit(":"), wide(F.col("starts")))
    on = turns.select(F.col("conv").alias("ac"), F.col("turn").alias("at"), F.col("branch").alias("up"))
    now = saved(heads.join(on, F.col("conv").eqNullSafe(F.col("ac")) & (F.col("answers") == F.col("at")), "left")
                     .select("conv", "starts", "up", F.array(step).alias("path")), "branches")
    while now.where("up IS NOT NULL").limit(1).count():
        above = now.select(F.col("conv").alias("ac"), F.col("starts").alias("as"), F.col("up").alias("next_up"),
                           F.col("path").alias("above"))
        now = saved(now.join(above, F.col("conv").eqNullSafe(F.col("ac")) & (F.col("up") == F.col("as")), "left")
                       .select("conv", "starts", F.col("next_up").alias("up"),
                               F.when(F.col("above").isNull(), F.col("path"))
                                .otherwise(F.concat("above", "path")).alias("path")), "branches")
    return now.select(F.col("conv").alias("pc"), F.col("starts").alias("pb"), "path")
