"""Mixing sources to target weights by hierarchical budgets (operator 4)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamline.llm.shared import stored

# Ranges of the shuffled order that one leaf is divided into, per this many rows.
ROWS_PER_RANGE = 1_000
SPACE = 1 << 62


@dataclass(frozen=True)
class Mix:
    """What to draw. A level's weights map its values to weights; others weigh 1.

    ``share`` is the budget as a share of all tokens; ``epochs`` is how often a document may be drawn.
    """

    levels: tuple[str, ...] = ("domain", "lang", "source")
    weights: Mapping[str, Mapping[str, float]] = field(default_factory=dict)
    share: float = 0.5
    epochs: int = 4
    seed: int = 17


def words_in(text: Column) -> Column:
    """Tokens of a text: maximal runs without ASCII white space. NULL has none."""
    clean = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))
    spaces = F.length(clean) - F.length(F.replace(clean, F.lit(" "), F.lit("")))
    return F.when(clean == "", 0).otherwise(spaces + 1).cast("bigint")


def weight_of(level: str, mix: Mix) -> Column:
    known = mix.weights.get(level, {})
    chosen = [F.when(F.col(level) == name, float(w)) for name, w in known.items()]
    return F.coalesce(*chosen, F.lit(1.0))


def filled(nodes: DataFrame, parents: Sequence[str], budget: str, capacity: str) -> DataFrame:
    """Give each parent's budget to its children by weight, none more than its capacity.

    What a child cannot take goes to its siblings by their weights. With children in order of
    capacity over weight, the first ones are filled up and the rest share alike: the level is
    (budget - capacities before) / (weights from here on). Adds ``given``.
    """
    order = Window.partitionBy(*parents).orderBy("__full_at", *nodes.columns[: len(parents) + 1])
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    open_level = (F.col(budget) - F.coalesce(F.sum(capacity).over(before), F.lit(0))) / F.sum(
        "weight"
    ).over(onward)
    # The first child that the level does not fill decides; from there on it can only fall.
    after = F.max(F.when(F.col("__level") <= F.col("__full_at"), F.col("__level"))).over(
        Window.partitionBy(*parents)
    )
    return (
        nodes.withColumn("__full_at", F.col(capacity) / F.col("weight"))
        .withColumn("__level", open_level)
        .withColumn("__after", after)
        .withColumn(
            "given",
            F.when(
                F.col("__after").isNotNull() & (F.col("__full_at") >= F.col("__after")),
                F.least(F.col(capacity).cast("double"), F.col("__after") * F.col("weight")),
            ).otherwise(F.col(capacity).cast("double")),
        )
        .drop("__full_at", "__level", "__after")
    )


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """Tokens to draw from each leaf; ``leaves`` has the levels, ``rows`` and ``tokens``.

    From the root down each node divides its budget among its children. A subtree can take its
    tokens times the epochs, so a shortage goes to siblings first, and only what a whole subtree
    cannot take goes to the siblings of its ancestor. Leaves are few against documents. The part of a
    token that a leaf's share ends with is dropped.
    """
    levels = list(mix.levels)
    able = F.col("tokens") * mix.epochs
    tree = leaves.withColumn("__capacity", able)
    given = leaves.agg(
        (F.coalesce(F.sum("tokens"), F.lit(0)) * mix.share).alias("given")
    ).withColumn("__root", F.lit(0))
    tree = tree.withColumn("__root", F.lit(0))
    path = ["__root"]
    for level in levels:
        nodes = (
            tree.groupBy(*path, level)
            .agg(F.sum("__capacity").alias("capacity"))
            .withColumn("weight", weight_of(level, mix))
            .filter(F.col("weight") > 0)
            .join(given.withColumnRenamed("given", "budget"), path)
            .select(*path, level, "capacity", "weight", "budget")
        )
        path = [*path, level]
        given = filled(nodes, path[:-1], "budget", "capacity").select(*path, "given")
    # Every leaf is an own node, so the last level's grouping is by leaf. The tiny shift keeps a
    # whole budget whole after divisions.
    return leaves.join(given, levels).withColumn(
        "budget", F.least(able, F.floor(F.col("given") + 1e-6).cast("bigint"))
    ).select(*levels, "rows", "tokens", "budget")




def leaf_name(level: str) -> Column:
    return F.coalesce(F.col(level).cast("string"), F.lit(""))


def measured(docs: DataFrame, mix: Mix, id_column: str, text_column: str) -> DataFrame:
    """Leaf, tokens and two sort keys of every document, without its text.

    Equal ids fall in order of their text; equal rows share a place and are drawn together.
    """
    return docs.select(
        *[leaf_name(level).alias(level) for level in mix.levels],
        F.col(id_column).alias("__id"),
        words_in(F.col(text_column)).alias("tokens"),
        F.xxhash64(F.lit(mix.seed), F.col(id_column), F.col(text_column)).alias("__hash"),
    ).withColumn("__place", F.shiftright("__hash", 2) + F.lit(SPACE >> 1))


def cuts(measures: DataFrame, leaves: DataFrame) -> DataFrame:
    """Per leaf: whole epochs, and the place up to which one epoch more is drawn.

    A leaf's order is divided into ranges by its size, so that no task holds a whole leaf: sums per
    range find the one range in which the budget runs out, and only its documents are sorted.
    """
    levels = [c for c in leaves.columns if c not in ("rows", "tokens", "budget")]
    plan = leaves.withColumns(
        {
            "full": F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0),
            "ranges": F.ceil(F.col("rows") / ROWS_PER_RANGE),
        }
    ).withColumn("rest", F.col("budget") - F.col("full") * F.col("tokens"))
    step = F.floor(F.col("__place") / (F.lit(SPACE) / F.col("ranges")))
    ranged = measures.join(plan.select(*levels, "ranges"), levels).withColumn("range", step)
    sums = ranged.groupBy(*levels, "range").agg(F.sum("tokens").alias("tokens"))
    order = Window.partitionBy(*levels).orderBy("range")
    crossing = (
        sums.join(plan.select(*levels, "rest"), levels)
        .withColumn("until", F.sum("tokens").over(order))
        .filter((F.col("until") > F.col("rest")) & (F.col("until") - F.col("tokens") <= F.col("rest")))
        .select(*levels, "range", (F.col("rest") - (F.col("until") - F.col("tokens"))).alias("left"))
    )
    inside = Window.partitionBy(*levels, "range").orderBy("__place")
    # Rows of one place (equal rows) come or go together.
    first_out = (
        ranged.join(crossing, [*levels, "range"])
        .withColumn("sum", F.sum("tokens").over(inside))
        .filter(F.col("sum") > F.col("left"))
        .groupBy(*levels)
        .agg(F.min("__place").alias("cut"))
    )
    # Whole epochs that use up the budget leave nothing for another one.
    cut = F.when((F.col("tokens") > 0) & (F.col("rest") <= 0), 0).otherwise(
        F.coalesce("cut", F.lit(SPACE))
    )
    return plan.join(first_out, levels, "left").select(
        *levels, F.col("full").cast("int").alias("full"), cut.alias("cut")
    )


def drawn(
    docs: DataFrame, mix: Mix, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The documents drawn, once for each epoch: the columns of ``docs`` and ``epoch`` (0, 1, ...).

    Each leaf draws its budget: whole epochs first, then the documents of one more epoch in seeded
    order for as long as all tokens so far fit the budget (a prefix). Equal rows share a place and
    are drawn or left together. NULL levels count as an empty name, NULL texts have no tokens and are
    drawn while their place is within the prefix. An existing column ``epoch`` is replaced, others
    stay. An empty table gives an empty table.
    """
    spark, levels = docs.sparkSession, list(mix.levels)
    measures = stored(measured(docs, mix, id_column, text_column), spark, "mix-measures")
    leaves = measures.groupBy(*levels).agg(F.count("*").alias("rows"), F.sum("tokens").alias("tokens"))
    planned = stored(budgets(leaves, mix), spark, "mix-budgets")
    wanted = stored(cuts(measures, planned), spark, "mix-cuts").select(
        *[F.col(level).alias(f"__leaf_{i}") for i, level in enumerate(levels)],
        F.col("full").alias("__full"),
        F.col("cut").alias("__cut"),
    )
    place = F.shiftright(
        F.xxhash64(F.lit(mix.seed), F.col(id_column), F.col(text_column)), 2
    ) + F.lit(SPACE >> 1)
    placed = docs.drop("epoch").withColumns(
        {f"__leaf_{i}": leaf_name(level) for i, level in enumerate(levels)} | {"__place": place}
    )
    times = F.col("__full") + (F.col("__place") < F.col("__cut")).cast("int")
    return (
        placed.join(wanted, [f"__leaf_{i}" for i in range(len(levels))])
        .withColumn("__times", times)
        .filter(F.col("__times") > 0)
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("__times") - 1)))
        .select(*docs.drop("epoch").columns, "epoch")
    )
