"""Mixing sources to target weights: iterative proportional fitting, then a calibrated sample.

Documents fall into cells (source, language, topic) that hold token counts.  Raking scales the cells' weights to each
dimension's target shares in turn, for a fixed number of rounds; a cell's ratio is its weight over its tokens.  A
document is drawn with probability ``min(1, c * ratio)``, where c is solved so that the expected tokens are ``fraction``
of all tokens, and the draw is a hash of its id, so a rerun draws the same documents.

Only DataFrame functions run on the data: the documents are aggregated once (partial sums, so a hot source is a few
rows per task) and everything else works on the cell table, which is written after every round.

Defined results: a null in a dimension is a value of its own; null and empty texts have no token and the ratio of their
cell (0 if the cell has no token, so they are not drawn unless ``fraction`` is 1 or more); repeated rows count and are
drawn alike; a null id is drawn by its text; a target of a value that no document has is spread over the others; an
empty table gives an empty result; extra columns are kept by ``sample`` and ignored elsewhere; a column ``topic`` is
used if there is one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goalpost.llm.common import saved

DIMENSIONS = ("source", "lang", "topic")
ROUNDS, SOLVE_STEPS = 8, 6
#: Target shares are the token shares to this power, scaled to 1; the share of tokens to draw.
FLATTEN, FRACTION, SEED = 0.7, 0.75, 17
_NULL = "\u0000"


def topic_of(text: Column) -> Column:
    """Topic by form (fixed rule): table rows, shouted lines, symbol noise, or prose."""
    return (F.when(F.coalesce(F.length(text), F.lit(0)) == 0, "empty")
             .when(F.contains(text, F.lit(" | ")), "table")
             .when(F.contains(text, F.lit("!! ")), "shout")
             .when(F.contains(text, F.lit("&&& ")) | F.contains(text, F.lit("### ")), "symbols")
             .otherwise("prose"))


def keyed(docs: DataFrame) -> tuple[Column, ...]:
    """The dimensions' values of a row, null as a value of its own."""
    topic = docs["topic"].cast("string") if "topic" in docs.columns else topic_of(docs["text"])
    return tuple(F.coalesce(c, F.lit(_NULL)).alias(f"mix_{k}") for k, c in zip(
        DIMENSIONS, (docs["source"].cast("string"), docs["lang"].cast("string"), topic), strict=True))


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def cells(rows: DataFrame) -> DataFrame:
    keys = [f"mix_{k}" for k in DIMENSIONS]
    return rows.groupBy(*keys).agg(F.sum("mix_tokens").alias("n"))


def flattened(table: DataFrame, dimension: str, power: float = FLATTEN) -> DataFrame:
    """(value, target): the dimension's token shares to a power."""
    return (table.groupBy(F.col(f"mix_{dimension}").alias("value"))
                 .agg(F.pow(F.sum("n").cast("double"), power).alias("target")))


def rake(table: DataFrame, targets: Mapping[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``table`` with ``w``: weights whose marginals have been scaled to the targets' shares, ``rounds`` times."""
    now = saved(table.withColumn("w", F.col("n").cast("double")), "mix-cells")
    total = now.agg(F.sum("w")).first()[0] or 0.0
    names = []
    for k, t in targets.items():
        # shares over the values that hold tokens
        held = now.groupBy(F.col(f"mix_{k}").alias("value")).agg(F.sum("w").alias("have")).where("have > 0")
        goal = saved(held.join(t.groupBy("value").agg(F.sum("target").alias("target")), "value")
                         .select("value", "target"), "mix-target")
        share = goal.agg(F.sum("target")).first()[0] or 1.0
        goal = goal.select(F.col("value").alias(f"mix_{k}"), (F.col("target") / share * total).alias(f"goal_{k}"))
        now = now.join(goal, f"mix_{k}", "left").fillna(0.0, [f"goal_{k}"])
        names.append(k)
    now = saved(now, "mix-goals")
    for _ in range(rounds):
        # one row a cell: each dimension's weight is a sum over the cells of a value, next to the cell itself
        for k in names:
            have = F.sum("w").over(Window.partitionBy(f"mix_{k}"))
            now = now.withColumn("have", have).withColumn(
                "w", F.col("w") * F.when(F.col("have") > 0, F.col(f"goal_{k}") / F.col("have")).otherwise(0.0)).drop("have")
        now = saved(now, "mix-round")
    return now.drop(*[f"goal_{k}" for k in names])


def probabilities(raked: DataFrame, fraction: float = FRACTION, steps: int = SOLVE_STEPS) -> DataFrame:
    """Cells with ``p``: the probability of drawing a document of the cell, to six decimals."""
    ratio = F.when(F.col("n") > 0, F.col("w") / F.col("n")).otherwise(0.0)
    table = raked.withColumn("ratio", ratio)
    c = fraction
    for _ in range(steps):
        full = F.col("ratio") * F.lit(c) >= 1
        r = table.agg(F.sum(F.when(full, F.col("n"))).alias("whole"), F.sum(F.when(~full, F.col("w"))).alias("part"),
                      F.sum("n").alias("n")).first()
        if not r["part"]:
            break
        c = max(0.0, (fraction * r["n"] - (r["whole"] or 0)) / r["part"])
    return table.withColumn("p", F.round(F.least(F.lit(1.0), F.col("ratio") * F.lit(c)), 6))


def draw(doc_id: Column, text: Column, seed: int = SEED) -> Column:
    """A number in [0, 1) from the id, or from the text of a row without one."""
    name = F.coalesce(doc_id.cast("string"), F.concat(F.lit("t"), F.coalesce(text, F.lit(""))))
    digest = F.md5(F.concat(name, F.lit(f":{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _planned(rows: DataFrame, targets: Mapping[str, DataFrame] | None, fraction: float) -> DataFrame:
    table = saved(cells(rows), "mix-counts")
    if targets is None:
        targets = {k: flattened(table, k) for k in DIMENSIONS}
    return probabilities(rake(table, targets), fraction).select(*[f"mix_{k}" for k in DIMENSIONS], "p")


def weigh(docs: DataFrame, targets: Mapping[str, DataFrame] | None = None, fraction: float = FRACTION,
          seed: int = SEED) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, probability and the draw of every row; ``targets`` are (value, target)
    tables by dimension, the flattened token shares by default."""
    keys = [f"mix_{k}" for k in DIMENSIONS]
    rows = saved(docs.select(docs["doc_id"].alias("mix_id"), draw(docs["doc_id"], docs["text"], seed).alias("mix_u"),
                             n_tokens(docs["text"]).alias("mix_tokens"), *keyed(docs)), "mix-rows")
    plain = [F.when(F.col(k) != _NULL, F.col(k)).alias(k.removeprefix("mix_")) for k in keys]
    return (rows.join(_planned(rows, targets, fraction), keys)
                .select(F.col("mix_id").alias("doc_id"), *plain, F.col("mix_tokens").alias("n_tokens"),
                        F.col("p").alias("probability"), (F.col("mix_u") < F.col("p")).alias("sampled")))


def sample(docs: DataFrame, targets: Mapping[str, DataFrame] | None = None, fraction: float = FRACTION,
           seed: int = SEED) -> DataFrame:
    """The drawn rows of ``docs``, all columns as they were."""
    keys = [f"mix_{k}" for k in DIMENSIONS]
    rows = docs.select(n_tokens(docs["text"]).alias("mix_tokens"), *keyed(docs))
    plan = _planned(rows, targets, fraction).select(*[F.col(k).alias(f"plan_{k}") for k in keys], "p")
    # row values are wrapped, so no column of docs can clash with the plan's
    wrapped = docs.select(F.struct(*docs.columns).alias("row"), draw(docs["doc_id"], docs["text"], seed).alias("u"),
                          *keyed(docs))
    on = [F.col(k) == F.col(f"plan_{k}") for k in keys]
    return wrapped.join(plan, on).where(F.col("u") < F.col("p")).select("row.*")
