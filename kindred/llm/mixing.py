"""Mixing sources to target weights by hierarchical token budgets.

Only DataFrame functions. Documents hang in a domain - language - source
tree. A token budget runs down from the root: a node's budget is split over
its children by weight, and what a child cannot take (its sources repeated
``max_epochs`` times) is shared out among its siblings by weight. As a
node's capacity is that of its subtree, a shortage goes to siblings first
and reaches the next level up only when the whole subtree is full. Each
source then takes whole epochs, and of one more epoch the prefix, in seeded
order, that fits the rest of its budget.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kindred.llm.common import staged

TREE = ["domain", "lang", "source"]
TOKEN = r"[^\x20\x09-\x0D]+"
# Source plans up to this many rows are broadcast (about 200 bytes a row).
BROADCAST_ROWS = 100_000


@dataclass
class Mix:
    """Parameters. Weights are by node name within each level; a node not
    named weighs 1, a weight of 0 leaves a node out."""
    budget_share: float = 0.5          # of all tokens
    max_epochs: int = 4
    seed: str = "mix-1"
    weights: dict[str, dict[str, int]] = field(default_factory=dict)
    domain: str = ("concat('domain', coalesce(try_cast(regexp_extract(source, '[0-9]+', 0) AS BIGINT), 0) % 4)")


def tree_columns(docs: DataFrame, mix: Mix) -> list[Column]:
    """``domain, lang, source, tokens, body`` of a row. Null names are read
    as the empty string; ``body`` is a digest of the text."""
    return [F.coalesce(F.expr(mix.domain), F.lit("")).alias("domain"),
            F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
            F.coalesce(F.regexp_count("text", F.lit(TOKEN)), F.lit(0)).cast("long").alias("tokens"),
            F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("body")]


def _place(mix: Mix, epoch) -> Column:
    """Place of a document in the seeded order of an epoch: equal only for
    rows equal in id and text, which are taken together or not at all."""
    return F.md5(F.concat_ws(":", F.lit(mix.seed), epoch.cast("string"),
                             F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "body").cast("binary"))


def _weight(mix: Mix, level: str) -> Column:
    w = F.lit(1)
    for name, v in mix.weights.get(level, {}).items():
        w = F.when(F.col(level) == name, v).otherwise(w)
    return w.cast("double")


def _share(nodes: DataFrame, parent: list[str], level: str, mix: Mix) -> DataFrame:
    """Splits ``budget`` of each parent over its children with capacity
    ``cap``: everyone gets weight x the level at which the budget is used
    up, at most its capacity. Children are scanned by capacity per weight;
    the level is the largest of the running candidates."""
    w = nodes.withColumn("w", _weight(mix, level))
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    before = by.orderBy(F.col("cap") / F.col("w"), level).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    got = w.withColumn("from", F.sum("w").over(by) - F.coalesce(F.sum("w").over(before), zero)) \
        .withColumn("full", F.coalesce(F.sum("cap").over(before), F.lit(0))) \
        .withColumn("level", F.max((F.col("budget") - F.col("full")) / F.col("from")).over(by))
    return got.select(*parent, level, F.least(F.col("cap").cast("double"), F.col("w") * F.col("level")).alias("budget"))


def source_budgets(rows: DataFrame, mix: Mix) -> DataFrame:
    """``domain, lang, source, have, budget`` (tokens) of each source that
    has tokens and no weight of 0 above it; ``rows`` has the columns of
    ``tree_columns``. The whole budget is a share of all tokens."""
    leaf = staged(rows.where("tokens > 0").groupBy(*TREE).agg(F.sum("tokens").alias("have")), "mix-leaves") \
        .withColumn("cap", F.col("have") * mix.max_epochs)
    budget = float(math.floor((leaf.agg(F.sum("have")).first()[0] or 0) * mix.budget_share))
    for level in TREE:  # what a weight of 0 leaves out is no capacity of the nodes above
        leaf = leaf.where(_weight(mix, level) > 0)
    given = leaf.groupBy("domain").agg(F.sum("cap").alias("cap")).withColumn("budget", F.lit(budget))
    given = _share(given, [], "domain", mix)
    given = leaf.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")).join(given, "domain")
    given = _share(given, ["domain"], "lang", mix)
    given = _share(leaf.join(given, ["domain", "lang"]), ["domain", "lang"], "source", mix)
    return leaf.join(given, TREE).select(*TREE, "have", F.floor(F.round("budget", 3)).cast("long").alias("budget"))


def plan(rows: DataFrame, mix: Mix) -> DataFrame:
    """``domain, lang, source, epochs, cut`` of each source: whole epochs,
    and the last place taken in one more. ``rows`` is stored. Where the
    budget of a source ends is found by sums over 256 ranges of places, by
    256 parts of the one range it ends in, then by order inside that part."""
    goal = staged(source_budgets(rows, mix).withColumn("epochs", F.expr("budget div have"))
                  .withColumn("rest", F.expr("budget % have")), "mix-goal")
    placed = rows.where("tokens > 0").join(hinted(goal.select(*TREE, "epochs", "rest")), TREE) \
        .withColumn("place", _place(mix, F.col("epochs")))
    ends = goal.select(*TREE, F.lit("").alias("range"), F.lit(0).cast("long").alias("before"))
    for digits in (2, 4):
        ends = staged(_range_ends(_inside(placed, ends, digits - 2), digits), "mix-ends")
    inside = Window.partitionBy(*TREE).orderBy("place").rangeBetween(Window.unboundedPreceding, 0)
    last = _inside(placed, ends, 4).withColumn("upto", F.col("before") + F.sum("tokens").over(inside)) \
        .where("upto <= rest").groupBy(*TREE).agg(F.max("place").alias("last"))
    return staged(goal.join(ends, TREE).join(last, TREE, "left")
                  .select(*TREE, "epochs", F.coalesce("last", "range").alias("cut")), "mix-plan")


def _inside(placed: DataFrame, ends: DataFrame, digits: int) -> DataFrame:
    """The rows of each source whose place starts with its ``range``."""
    return placed.withColumn("range", F.substring("place", 1, digits)).join(hinted(ends), [*TREE, "range"])


def _range_ends(rows: DataFrame, digits: int) -> DataFrame:
    """``range, before`` of each source: the range of places (by leading hex
    digits) in which its rest ends, and the tokens before that range."""
    sums = rows.groupBy(*TREE, "rest", "before", F.substring("place", 1, digits).alias("part")).agg(F.sum("tokens").alias("n"))
    upto = Window.partitionBy(*TREE).orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    return sums.withColumn("upto", F.col("before") + F.sum("n").over(upto)) \
        .where("upto > rest AND upto - n <= rest") \
        .select(*TREE, F.col("part").alias("range"), (F.col("upto") - F.col("n")).alias("before"))


def hinted(df: DataFrame) -> DataFrame:
    """Broadcast hint for a stored table of sources, if its count allows it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def mix_rows(docs: DataFrame, mix: Mix, keep: list[str]) -> DataFrame:
    """The mixed corpus: one row for each document and epoch it is taken in,
    with columns ``keep`` of ``docs`` (those not named as the others), then
    ``domain, tokens, epoch``, and ``lang, source`` where kept.

    Documents without tokens (null or blank text) are never taken. No row of
    ``docs``, or a budget of 0, gives no row. Sources whose weight or whose
    ancestor's weight is 0 get nothing.
    """
    rows = staged(docs.select("doc_id", *tree_columns(docs, mix)), "mix-rows")
    chosen = plan(rows, mix).select(*[F.col(c).alias(f"_{c}") for c in TREE], "epochs", "cut")
    own = [c for c in keep if c not in ("domain", "tokens", "epoch")]
    tree = docs.select(F.struct(*[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(own)]).alias("own"), "doc_id",
                       *[c.alias(f"_{n}") for c, n in zip(tree_columns(docs, mix)[:3], TREE)],
                       *tree_columns(docs, mix)[3:]).where("tokens > 0")
    took = tree.join(hinted(chosen), [f"_{c}" for c in TREE]) \
        .withColumn("more", F.when(_place(mix, F.col("epochs")) <= F.col("cut"), 1).otherwise(0)) \
        .where("epochs + more > 0").withColumn("epoch", F.explode(F.expr("sequence(0L, epochs + more - 1)")))
    return took.select(*[F.col(f"own.k{i}").alias(c) for i, c in enumerate(own)],
                       F.col("_domain").alias("domain"), "tokens", F.col("epoch").cast("int").alias("epoch"))
