"""Mixing of sources to target weights by budgets in a tree.

The leaves of the tree are the distinct values of some columns (domain,
language, source). A budget of tokens is handed down from the root in
proportion to the children's weights. A child can use at most what its leaves
hold over `max_epochs` epochs; what it cannot use goes to its siblings, again
by weight, and only what all of them cannot use shows up as a shortage of
their parent, whose siblings then take it. Handing down level by level does
that, as a node's room is the sum of its leaves' room.

A leaf takes whole epochs and then a prefix of one more, in an order seeded by
the number of the epoch. The prefix is a limit on the order's key, found by
sums over ranges of the key, so no leaf is ever sorted as a whole and documents
are only compared with the limit of their leaf.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import stored, unused

WORD = r"[^\x20\x09-\x0D]+"
KEY_DIGITS = 15
RANGE_DIGITS = 2


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def path_of(names: Sequence[str]) -> Column:
    """The name of a node: its values, each after a slash; slashes in them are doubled."""
    return F.concat(
        *(F.concat(F.lit("/"), F.replace(known(n), F.lit("/"), F.lit("//"))) for n in names)
    )


def known(name: str) -> Column:
    """A value of the path; null is the empty one."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def budgets(
    leaves: DataFrame, path: Sequence[str], weights: Mapping[str, int], total: int, max_epochs: int
) -> DataFrame:
    """Adds ``budget`` to `leaves`, which has the columns of `path` and ``tokens``.

    `weights` names nodes as `path_of` does; a node it does not name weighs 1.
    Weights are positive integers. Fractions of tokens are not handed out.
    """
    if any(weight <= 0 for weight in weights.values()):
        raise ValueError("weights are positive")
    weight = F.lit(1)
    if weights:
        pairs = chain.from_iterable((F.lit(k), F.lit(v)) for k, v in weights.items())
        weight = F.coalesce(F.create_map(*pairs)[F.col("_node")], weight)
    room = leaves.withColumn("_room", F.col("tokens") * max_epochs)
    given = None
    for level in range(1, len(path) + 1):
        above = path_of(path[: level - 1]) if level > 1 else F.lit("")
        nodes = room.groupBy(above.alias("_parent"), path_of(path[:level]).alias("_node")).agg(
            F.sum("_room").alias("_room")
        )
        if given is None:
            nodes = nodes.withColumn("_budget", F.lit(int(total)).cast("long"))
        else:
            nodes = nodes.join(given, "_parent")
        given = _shared_out(nodes.withColumn("_weight", weight)).select(
            F.col("_node").alias("_parent"), "_budget"
        )
    return (
        leaves.withColumn("_parent", path_of(path))
        .join(given, "_parent")
        .withColumnRenamed("_budget", "budget")
        .drop("_parent")
    )


def _shared_out(nodes: DataFrame) -> DataFrame:
    """The nodes with ``_budget``: their parent's, by weight, within each one's room.

    In the order of room per weight, the first nodes are full: those whose room
    per weight is at most the rest of the budget per rest of the weight. The
    first that is not full sets the rate of all that follow.
    """
    order = Window.partitionBy("_parent").orderBy(F.col("_room") / F.col("_weight"), "_node")
    full_before = F.coalesce(
        F.sum("_room").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    weight_left = F.sum("_weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    rated = nodes.withColumn("_rate", (F.col("_budget") - full_before) / weight_left)
    open_rate = F.when(F.col("_room") / F.col("_weight") > F.col("_rate"), F.col("_rate"))
    rate = F.max(open_rate).over(Window.partitionBy("_parent"))
    own = F.when(open_rate.isNull(), F.col("_room")).otherwise(
        F.floor(F.col("_rate_open") * F.col("_weight"))
    )
    return rated.withColumn("_rate_open", rate).withColumn("_budget", own.cast("long"))


def order_key(seed: int, epoch: Column, doc_id: Column) -> Column:
    """A key of `KEY_DIGITS` hexadecimal digits that orders a leaf's documents in an epoch."""
    own = F.coalesce(doc_id.cast("string"), F.lit(""))
    name = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), own)
    return F.substring(F.md5(name.cast("binary")), 1, KEY_DIGITS)


def limits(sized: DataFrame, path: Sequence[str], seed: int, leaves: DataFrame) -> DataFrame:
    """Per leaf ``epochs``, taken whole, and ``last``, the last key of one more (or null).

    `leaves` has ``tokens`` and ``budget``. A document belongs to the prefix if the
    documents before it hold fewer tokens than are left; equal keys go together.
    """
    left = (
        leaves.withColumn(
            "epochs",
            F.when(F.col("tokens") > 0, F.floor(F.try_divide("budget", "tokens"))).otherwise(0),
        )
        .withColumn("left", F.col("budget") - F.col("epochs") * F.col("tokens"))
        .select(path_of(path).alias("leaf"), F.col("epochs").cast("int"), "left")
    )
    left = stored(left, "leaf-budgets")
    rows = (
        sized.withColumn("leaf", path_of(path))
        .join(left.where("left > 0"), "leaf")
        .select(
            "leaf", "n_tokens", "left",
            order_key(seed, F.col("epochs"), F.col("doc_id")).alias("key"),
        )
    )
    for digits in (RANGE_DIGITS, 2 * RANGE_DIGITS, 3 * RANGE_DIGITS, KEY_DIGITS):
        own = F.substring("key", 1, digits).alias("range")
        ranges = rows.groupBy("leaf", "left", own).agg(F.sum("n_tokens").alias("n"))
        order = Window.partitionBy("leaf").orderBy("range")
        before = F.coalesce(
            F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        )
        reached = (
            ranges.withColumn("before", before)
            .where(F.col("before") < F.col("left"))
            .groupBy("leaf", "left")
            .agg(F.max_by(F.struct("range", "before"), "range").alias("at"))
            .select("leaf", (F.col("left") - F.col("at.before")).alias("left"), "at.range")
        )
        if digits < KEY_DIGITS:
            cut = stored(reached.withColumnRenamed("range", "_range"), "ranges")
            rows = (
                rows.drop("left")
                .join(cut, "leaf")
                .where(F.substring("key", 1, digits) == F.col("_range"))
                .drop("_range")
            )
    last = reached.select("leaf", F.col("range").alias("last"))
    return left.select("leaf", "epochs").join(last, "leaf", "left")


def mixed(
    docs: DataFrame,
    path: Sequence[str],
    weights: Mapping[str, int],
    total: int | None = None,
    max_epochs: int = 1,
    seed: int = 0,
    tokens: str = "n_tokens",
    epoch: str = "epoch",
    share: int | None = None,
) -> DataFrame:
    """The documents with `epoch`: a row for every epoch that takes the document.

    `docs` needs ``doc_id``, the column `tokens` and those of `path`; all columns
    are kept, but for one named `epoch`, which is replaced. `total` is the budget in tokens, by default `share` percent of what the documents hold, or all of it.
    Rows with equal ids have equal keys and are taken together; null ids have the
    key of an empty name. A leaf without tokens is never taken. No rows give none.
    """
    sized = stored(
        docs.select(
            "doc_id", *(known(n).alias(n) for n in path), F.col(tokens).alias("n_tokens")
        ),
        "sized",
    )
    leaves = sized.groupBy(*path).agg(F.sum("n_tokens").alias("tokens"))
    leaves = stored(leaves, "leaves", rows=sized.count())
    if total is None:
        total = (leaves.agg(F.sum("tokens")).first()[0] or 0) * (100 if share is None else share) // 100
    limit = stored(
        limits(sized, path, seed, budgets(leaves, path, weights, total, max_epochs)),
        "limits",
        rows=leaves.count(),
    )
    leaf, epochs, last, times = unused(docs.columns, "leaf", "epochs", "last", "times")
    key = order_key(seed, F.col(epochs), F.col("doc_id"))
    return (
        docs.withColumn(leaf, path_of(path))
        .join(limit.toDF(leaf, epochs, last), leaf)
        .withColumn(times, F.col(epochs) + F.when(key <= F.col(last), 1).otherwise(0))
        .where(F.col(times) > 0)
        .withColumn(epoch, F.explode(F.sequence(F.lit(0), F.col(times) - 1)))
        .select(*(n for n in docs.columns if n != epoch), epoch)
    )
