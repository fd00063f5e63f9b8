"""From buckets of likely neighbours to components, without all pairs of a bucket."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from salesloom.llm.common import stored
from salesloom.llm.components import components


@dataclass(frozen=True)
class Marks:
    """What is known of each ``node`` besides its size, and which pairs that allows.

    ``allowed`` gets the suffixes of the two sides' columns.
    """

    table: DataFrame
    allowed: Callable[[str, str], Column]

# Members of a bucket meet at once if that makes so many pairs per member at most.
FEW = 8


def shared_buckets(buckets: DataFrame) -> DataFrame:
    """Rows (``bucket``, ``node``, ``size``) of buckets with two nodes or more, with their smallest node.

    One shuffle and one sort by bucket.  ``size`` is the size of the node's set.
    """
    whole = W.partitionBy("bucket")
    return (
        buckets.withColumn("low", F.min(F.struct("node", "size")).over(whole))
        .withColumn("high", F.max("node").over(whole))
        .where("low.node <> high")
        .select("bucket", "node", "size", F.col("low.node").alias("low"), F.col("low.size").alias("low_size"))
    )


def _could(left: str, right: str, percent: int) -> str:
    """Whether two sets of these sizes can have the similarity at all."""
    return f"100 * least({left}, {right}) >= {percent} * greatest({left}, {right})"


def near_enough(left: str, right: str, percent: int, words: int | None = None) -> Column:
    """Whether two sets of ``n`` elements can have the similarity, by the bits in which their parity sketches differ.

    Sets of that similarity differ in so many elements at most, and their
    sketches in no more bits: no similar pair is left out.  With ``words`` given
    it is spelled out word by word, which is compiled.
    """
    if words is None:
        unequal = F.zip_with(f"sketch{left}", f"sketch{right}", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
        differing = F.aggregate(unequal, F.lit(0), lambda total, bits: total + bits)
    else:
        differing = F.lit(0)
        for word in range(words):
            bits = F.get(f"sketch{left}", F.lit(word)).bitwiseXOR(F.get(f"sketch{right}", F.lit(word)))
            differing = differing + F.bit_count(bits)
    return differing * (100 + percent) <= (F.col(f"n{left}") + F.col(f"n{right}")) * (100 - percent)


def _hub_pairs(members: DataFrame, salt: int, percent: int) -> DataFrame:
    """Each member against one hub of its bucket from another component."""
    ranked = members.select("*", F.xxhash64("node", F.lit(salt)).alias("order"))
    hubs = ranked.groupBy("bucket").agg(
        F.min_by(F.struct("node", "component", "size"), "order").alias("hub"),
        F.min("component").alias("c1"),
        F.max("component").alias("c2"),
    )
    return (
        members.join(hubs.where("c1 <> c2").select("bucket", "hub.*").toDF("bucket", "hub", "hub_c", "hub_size"), "bucket")
        .where("component <> hub_c")
        .where(_could("size", "hub_size", percent))
        .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
        .distinct()
    )


def _cross_pairs(members: DataFrame, percent: int, marks: Marks | None) -> DataFrame:
    """All pairs of a bucket that no component joins yet and whose sizes and marks allow the similarity."""
    open_buckets = members.groupBy("bucket").agg(F.min("component").alias("c1"), F.max("component").alias("c2"))
    left = members.join(open_buckets.where("c1 <> c2").select("bucket"), "bucket", "left_semi")
    allowed = F.expr(_could("size", "size_2", percent))
    if marks is not None:
        left = left.join(marks.table, "node")
        allowed = allowed & marks.allowed("", "_2")
    right = left.select("bucket", *[F.col(c).alias(f"{c}_2") for c in left.columns if c != "bucket"])
    return (
        left.join(right, "bucket")
        .where((F.col("node") < F.col("node_2")) & (F.col("component") != F.col("component_2")) & allowed)
        .select(F.col("node").alias("a"), F.col("node_2").alias("b"))
        .distinct()
    )


def untried(members: DataFrame, percent: int) -> DataFrame:
    """Members of buckets of which a pair in different components has not been confirmed or rejected yet.

    Where the sizes let all members meet the smallest one, that one is left
    out; most buckets have two members and so no pair left.  ``few``: whether
    the bucket's pairs in different components are ``FEW`` per member at most.
    """
    met = F.bool_and(F.expr(_could("size", "low_size", percent))).alias("met")
    rest = members.join(members.groupBy("bucket").agg(met), "bucket").where("not met or node <> low")
    # Members of one component are no pairs, so a large group with some strangers has few.
    parts = rest.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    buckets = parts.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("inside"))
    left = buckets.where("n * n > inside").select("bucket", ((F.col("n") * F.col("n") - F.col("inside")) <= 2 * FEW * F.col("n")).alias("few"))
    return rest.join(left, "bucket").select("bucket", "node", "size", "component", "few")


def few_pairs(members: DataFrame) -> DataFrame:
    """All pairs of members of buckets with few that no component joins yet: ``FEW`` times the members at most."""
    left = members.where("few").select("bucket", "node", "component")
    right = left.toDF("bucket", "node_2", "component_2")
    return (
        left.join(right, "bucket")
        .where("component <> component_2")
        .select(F.least("node", "node_2").alias("a"), F.greatest("node", "node_2").alias("b"))
        .distinct()
    )


def prefix_pairs(members: DataFrame, percent: int, sets: DataFrame, words: int) -> DataFrame:
    """The pairs of nodes in open buckets that no component joins yet and whose rarest elements meet.

    With the elements of all sets in one order, rare ones first, two similar
    sets have their first common element so early that enough of either set is
    left after it; no such pair is lost.  Members of a group that share frequent
    elements only do not meet.  ``sets`` has ``node``, ``n``, ``sketch``
    (of so many ``words``) and ``elements``; a set meets those that are no smaller.
    """
    open_buckets = members.groupBy("bucket").agg(F.min("component").alias("c1"), F.max("component").alias("c2"))
    nodes = members.join(open_buckets.where("c1 <> c2").select("bucket"), "bucket", "left_semi")
    rows = stored(nodes.select("node", "component").distinct().join(sets, "node"), "open-sets")
    each = rows.select("node", F.explode("elements").alias("element"))
    often = each.groupBy("element").agg(F.count("*").alias("times"))
    rare = (
        each.join(often, "element")
        .groupBy("node")
        .agg(F.sort_array(F.collect_list(F.struct("times", "element"))).alias("ordered"))
        .withColumn("n", F.size("ordered"))
        .select("node", F.posexplode(F.expr(f"slice(ordered, 1, n - cast(ceil(n * {percent} / 100) as int) + 1)")).alias("at", "first"))
        .where("first.times > 1")
        .select("node", "at", F.col("first.element").alias("element"))
    )
    table = stored(rare.join(rows.select("node", "component", "n", "sketch"), "node"), "rare-elements")
    right = table.select("element", *[F.col(c).alias(f"{c}_2") for c in table.columns if c != "element"])
    # The smaller of two sets at the threshold has at least so many of its elements in common.
    left = table.where(f"(n - at) * {100 + percent} >= 2 * n * {percent}")
    needed = f"(n + n_2) * {percent}"
    enough = f"(n - at) * {100 + percent} >= {needed} and (n_2 - at_2) * {100 + percent} >= {needed}"
    return (
        left.join(right, "element")
        .where("(n < n_2 or (n = n_2 and node < node_2)) and component <> component_2")
        .where(enough)
        .where(near_enough("", "_2", percent, words))
        .select(F.least("node", "node_2").alias("a"), F.greatest("node", "node_2").alias("b"))
        .distinct()
    )


def linked_components(
    shared: DataFrame,
    confirm: Callable[[DataFrame], DataFrame],
    percent: int,
    hub_rounds: int = 0,
    marks: Marks | None = None,
    last: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``node`` and ``component`` of every node with a confirmed link to another one of its buckets.

    ``confirm`` takes pairs (``a``, ``b``) and returns those that are linked.
    First all members of a bucket meet its smallest node, then, in
    ``hub_rounds``, hubs drawn by hash from other components; copies of one text
    thus cost a link each, not one per pair.  The last pass meets every pair that
    is still in different components, so no link between components is lost;
    ``last`` may give the pairs of large buckets in another way.  It gets only
    members with a pair that has not been confirmed or rejected.
    """
    pairs = (
        shared.where("node <> low")
        .where(_could("size", "low_size", percent))
        .select(F.col("low").alias("a"), F.col("node").alias("b"))
        .distinct()
    )
    found = stored(components(confirm(pairs)), "components-found")
    for salt in range(1, hub_rounds + 2):
        members = stored(
            shared.select("bucket", "node", "size", *(("low", "low_size") if last else ()))
            .join(found, "node", "left")
            .withColumn("component", F.coalesce("component", "node")),
            "bucket-members",
        )
        if salt <= hub_rounds:
            pairs = _hub_pairs(members, salt, percent)
        elif last:
            rest = stored(untried(members, percent), "untried-members")
            pairs = few_pairs(rest).unionByName(last(rest.where("not few"))).distinct()
        else:
            pairs = _cross_pairs(members, percent, marks)
        more = stored(confirm(pairs), "links-found")
        if not more.isEmpty():
            known = found.select(F.col("component").alias("a"), F.col("node").alias("b"))
            found = stored(components(known.unionByName(more)), "components-found")
    return found
