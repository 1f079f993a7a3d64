"""Connected groups from pairs and from buckets, with DataFrame joins only."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.session import drop_shuffles, stage


# A round of leaders is worth another if it finds a link for so many open buckets at least.
WORTH = 100


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """`node, root`: for every node of the links `a, b` the smallest node it is connected with.

    Each round hangs every root on the smallest root across its links, then
    halves the paths; the number of rounds follows the logarithm of a group's
    diameter. A round's result is written to the shared folder. Links and nodes
    stay distributed, and a hub's links are reduced in each task before they move.
    """
    both = links.select("a", "b").filter("a <> b")
    edges = stage(both.union(both.select("b", "a")).distinct(), "links")
    # The first round's labels: the smallest neighbour or itself.
    labels = stage(
        edges.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("root")), "labels"
    )
    for _ in range(most_rounds):
        a, b = (labels.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}")) for x in "ab")
        crossing = (
            edges.join(a, "a").join(b, "b").filter("root_a > root_b").groupBy(F.col("root_a").alias("root"))
            .agg(F.min("root_b").alias("lower"))
        )
        hung = labels.join(crossing, "root", "left").select("node", F.coalesce("lower", "root").alias("root"))
        parents = hung.select(F.col("node").alias("root"), F.col("root").alias("upper"))
        labels_next = stage(
            hung.join(parents, "root", "left").select("node", F.coalesce("upper", "root").alias("root")), "labels"
        )
        changed = labels_next.join(labels.withColumnRenamed("root", "old"), "node").filter("root <> old")
        if changed.isEmpty():
            return labels_next
        labels = labels_next
    raise RuntimeError("components did not settle")


def _joined(labels: DataFrame, found: DataFrame) -> DataFrame:
    """The labels after more links: these connect roots, so earlier links are not walked again."""
    raised = found
    for side in "ab":
        own = labels.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
        raised = raised.join(own, side, "left")
    raised = raised.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    lower = components(raised.filter("a <> b").distinct())
    moved = labels.join(lower.select(F.col("node").alias("root"), F.col("root").alias("lower")), "root", "left")
    new = lower.join(labels.select("node"), "node", "left_anti").select("node", "root")
    return stage(moved.select("node", F.coalesce("lower", "root").alias("root")).union(new), "labels")


def _pair_up(one: DataFrame, two: DataFrame, marks: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both frames with `node`, `root` and the marks renamed for the sides a and b."""
    return tuple(
        df.select("bucket", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "root", *marks)])
        for df, side in ((one, "a"), (two, "b"))
    )


def link_buckets(
    buckets: DataFrame, marks: DataFrame, alike: Column, confirm: Callable[[DataFrame], DataFrame], rounds: int = 3,
    parts: int = 1,
) -> tuple[DataFrame, DataFrame]:
    """Labels and links of all confirmed pairs that share a bucket, less those inside a group already joined.

    `buckets` has bucket and node, `marks` a node's other columns; `alike` is a
    condition on those columns, with _a and _b after their names, that any link
    meets; `confirm` keeps the links among pairs `a, b`. In each round every bucket has one leader, another one each
    time, that its members of other groups are compared with; rounds that find little
    are the last such. At last all members of different groups meet, so no link between
    groups is lost; a group's own pairs are never made, and no pair is confirmed twice.
    With several parts the open buckets are not written, and compare their members a part at a
    time, so that less lies on disk at once.
    """
    labels: DataFrame | None = None
    links: DataFrame | None = None

    def labelled() -> DataFrame:
        if labels is None:
            return buckets.withColumn("root", F.col("node"))
        return buckets.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))

    known: DataFrame | None = None
    leaders = rounds > 0
    for turn in range(rounds + 1):
        if turn < rounds and not leaders:
            continue
        nodes = labelled()
        spread = nodes.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        mixed = stage(spread.filter("low <> high").select("bucket"), "mixed")
        if parts == 1:
            open_nodes = stage(nodes.join(mixed, "bucket").join(marks, "node"), "open")
        met = []
        for part in range(parts):
            if parts == 1:
                some = open_nodes
            else:
                own = F.pmod("bucket", F.lit(parts)) == part
                some = nodes.filter(own).join(mixed.filter(own), "bucket")
            lead = some
            if turn < rounds:
                first = some.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("node", F.lit(turn)), "node", "root")).alias("x"))
                lead = first.select("bucket", F.col("x.node").alias("node"), F.col("x.root").alias("root"))
                if parts == 1:
                    lead = some.join(lead.select("bucket", "node"), ["bucket", "node"])
            if parts > 1:
                lead, some = lead.join(marks, "node"), some.join(marks, "node")
            one, two = _pair_up(lead, some, [c for c in marks.columns if c != "node"])
            pairs = one.join(two, "bucket").filter((F.col("root_a") != F.col("root_b")) & alike)
            if turn == rounds:
                pairs = pairs.filter("node_a < node_b")
            pairs = pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b"))
            if parts > 1:
                pairs = stage(pairs.distinct(), "met")
                drop_shuffles(pairs.sparkSession)
            met.append(pairs)
        pairs = reduce(DataFrame.union, met).distinct()
        if known is not None:
            pairs = pairs.join(known, ["a", "b"], "left_anti")
        pairs = stage(pairs, "pairs")
        drop_shuffles(pairs.sparkSession)
        known = pairs if known is None else known.union(pairs)
        found = stage(confirm(pairs), "found")
        drop_shuffles(found.sparkSession)
        if labels is None:
            links, labels = found, components(found)
        elif not found.isEmpty():
            links, labels = links.union(found), _joined(labels, found)
        drop_shuffles(found.sparkSession)
        leaders = WORTH * found.count() >= mixed.count()
    return labels, links
