"""Mixing sources to target weights with a hierarchical token budget.

A budget goes down a tree of domains, languages and sources by the weights of siblings. What a node
cannot fill goes to its siblings first; only what a whole subtree cannot fill reaches the siblings
of its parent. Every leaf then takes a prefix of its documents in seeded order: whole epochs, and
the part of one more that exhausts its budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from ontime.session import materialize

PATH = ("domain", "lang", "source")
NONE = "(none)"  # a level without a value
DIGITS = 3  # hex digits of the order that a histogram is kept of
BROADCAST_LEAVES = 50_000

Weights = dict[tuple[str, ...], float]


def word_count(text: str = "text") -> Column:
    """Words between blanks, tabs and line ends; null: none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^ \t\n\r]+")), F.lit(0)).cast("long")


def share_out(nodes: DataFrame, parent: list[str]) -> DataFrame:
    """Split ``budget`` of each parent over its nodes by weight, none above its ``supply``.

    Nodes are filled in order of supply per weight. The level at which the rest of the budget meets
    the rest of the weights rises while nodes fill up and falls after that; its peak is the level
    of all that do not fill up. Nodes have a positive weight.
    """
    order = Window.partitionBy(*parent).orderBy(F.col("supply") / F.col("weight"), F.col("node"))
    filled = F.coalesce(F.sum("supply").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weights = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    levels = nodes.withColumn("level", (F.col("budget") - filled) / weights)
    peak = F.max("level").over(Window.partitionBy(*parent))
    return levels.withColumn("share", F.least(F.col("supply").cast("double"), peak * F.col("weight"))).drop("level")


def leaf_budgets(leaves: DataFrame, budget: int, path: list[str], weights: Weights, max_epochs: int) -> DataFrame:
    """Whole tokens per leaf; ``leaves`` has the path and tokens, a row per leaf."""
    spark = leaves.sparkSession
    given = [(len(k), "\x1f".join(k), float(w)) for k, w in weights.items()]
    table = spark.createDataFrame(given, "depth int, name string, weight double")
    supply = leaves.withColumn("supply", F.col("tokens") * max_epochs)
    above, budgets = ["root"], supply.groupBy(F.lit(0).alias("root")).agg(
        F.least(F.sum("supply"), F.lit(budget)).cast("double").alias("budget")
    )
    supply = supply.withColumn("root", F.lit(0))
    for depth in range(1, len(path) + 1):
        level = ["root", *path[:depth]]
        named = table.filter(F.col("depth") == depth).select(F.col("name").alias("node"), "weight")
        nodes = supply.groupBy(*level).agg(F.sum("supply").alias("supply")).withColumn(
            "node", F.concat_ws("\x1f", *path[:depth])
        ).join(named, "node", "left").withColumn("weight", F.coalesce("weight", F.lit(1.0)))
        nodes = nodes.filter("weight > 0 and supply > 0").join(budgets, above)
        budgets = share_out(nodes, above).select(*level, F.col("share").alias("budget"))
        above = level
    return budgets.select(*path, F.floor(F.col("budget") + 1e-6).cast("long").alias("budget"))


def without_tokens(leaves: DataFrame, path: list[str], weights: Weights) -> DataFrame:
    """The leaves that have documents but no tokens, less those that a weight of 0 leaves out."""
    spark = leaves.sparkSession
    barred = [(len(k), "\x1f".join(k)) for k, w in weights.items() if not w > 0]
    table = spark.createDataFrame(barred, "depth int, name string")
    empty = leaves.filter("tokens = 0")
    for depth in sorted({d for d, _ in barred}):
        named = table.filter(F.col("depth") == depth).select("name")
        empty = empty.join(named, F.concat_ws("\x1f", *path[:depth]) == F.col("name"), "left_anti")
    return empty.select(*path)


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    """Place of a document in the order of an epoch, as hex digits."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def leaf_cuts(units: DataFrame, budgets: DataFrame, path: list[str], seed: int) -> DataFrame:
    """Per leaf: whole epochs, and where the order of the next epoch is cut.

    Columns: path, epochs, cut (null: nothing of a further epoch), last (tokens of the document at
    the cut). A histogram of the order finds the slice with the cut; only that slice is ordered, so
    no task sees a whole leaf.
    """
    totals = units.groupBy(*path).agg(F.sum("tokens").alias("tokens"))
    leaves = materialize(totals.join(budgets, path).select(
        *path, F.expr("budget div tokens").cast("int").alias("epochs"), (F.col("budget") % F.col("tokens")).alias("rest"),
    ))
    ordered = units.join(leaves.filter("rest > 0"), path).withColumn(
        "place", order_key(seed, F.col("epochs"), F.col("doc_id"))
    ).select(*path, "rest", "tokens", "place", F.substring("place", 1, DIGITS).alias("slice"))
    slices = ordered.groupBy(*path, "slice").agg(F.sum("tokens").alias("in_slice"), F.first("rest").alias("rest"))
    down = Window.partitionBy(*path).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("in_slice").over(down), F.lit(0))
    at = slices.withColumn("start", start).filter("start < rest and rest <= start + in_slice").select(*path, "slice", "start")
    inside = Window.partitionBy(*path).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("start") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))
    cuts = ordered.join(at, [*path, "slice"]).withColumn("before", before).filter(
        "before < rest and rest <= before + tokens"
    ).select(*path, F.col("place").alias("cut"), (F.col("rest") - F.col("before")).alias("last"), F.col("tokens").alias("unit"))
    return leaves.join(cuts, path, "left").select(*path, "epochs", "cut", "last", "unit")


def mix_plan(
    documents: DataFrame, tokens: Column, budget: int | None = None, share: float | None = None,
    path: tuple[str, ...] = PATH, weights: Weights | None = None, max_epochs: int = 1, seed: int = 0,
) -> DataFrame:
    """The documents in the mix, one row per epoch they are in, with all their columns.

    Adds n_tokens, epoch (from 0) and taken_tokens, less than n_tokens only for the document at
    the cut of its leaf; columns of these names are replaced. ``budget`` is in tokens, or ``share``
    of all tokens there are. ``weights`` are relative to siblings, by path from the top; a missing
    one is 1, and 0 leaves a node out. A leaf is used ``max_epochs`` times at most; if all are, the
    mix is smaller than the budget.

    Null path values are a value of their own. Rows with one doc_id in one leaf are taken or left
    together, at the cut in proportion. Documents without tokens come along until the cut; a leaf
    of such documents alone has no cut and is taken whole, once, unless a weight of 0 leaves it
    out. A budget of 0 and empty tables give empty mixes. Documents are not shuffled; the table of leaves is broadcast where it
    has ``BROADCAST_LEAVES`` rows at most, and joined otherwise.
    """
    names = [f"_mix_{name}" for name in path]
    data = documents.drop("n_tokens", "epoch", "taken_tokens").withColumn("n_tokens", tokens)
    data = data.withColumns({f"_mix_{n}": F.coalesce(F.col(n).cast("string"), F.lit(NONE)) for n in path})
    units = materialize(data.groupBy(*names, "doc_id").agg(F.sum("n_tokens").alias("tokens")))
    every_leaf = units.groupBy(*names).agg(F.sum("tokens").alias("tokens"))
    leaves = every_leaf.filter("tokens > 0")
    if budget is None:
        budget = int((leaves.agg(F.sum("tokens")).first()[0] or 0) * (1.0 if share is None else share))
    budgets = leaf_budgets(leaves, budget, names, weights or {}, max_epochs)
    cuts = leaf_cuts(units, budgets, names, seed)
    if budget > 0 and max_epochs > 0:
        once = without_tokens(every_leaf, names, weights or {}).withColumn("epochs", F.lit(1))
        cuts = cuts.unionByName(once, allowMissingColumns=True)
    cuts = materialize(cuts.withColumnsRenamed({name: f"_mix_{name}" for name in ("epochs", "cut", "last", "unit")}))
    small = F.broadcast(cuts) if cuts.count() <= BROADCAST_LEAVES else cuts
    placed = data.join(small, names).withColumn(
        "epoch", F.explode(F.sequence(F.lit(0), F.col("_mix_epochs")))
    ).withColumn("_mix_place", order_key(seed, F.col("epoch"), F.col("doc_id")))
    taken = (
        F.when(F.col("epoch") < F.col("_mix_epochs"), F.col("n_tokens"))
        .when(F.col("_mix_place") < F.col("_mix_cut"), F.col("n_tokens"))
        .when(F.col("_mix_place") == F.col("_mix_cut"), F.expr("n_tokens * _mix_last div _mix_unit"))
    )
    chosen = placed.withColumn("taken_tokens", taken.cast("long")).filter("taken_tokens is not null")
    return chosen.drop(*names, "_mix_epochs", "_mix_cut", "_mix_last", "_mix_unit", "_mix_place")
