"""A Merkle manifest of a table of documents: trees by nested intervals, proofs, and their check.

Every node carries the interval ``[low, high)`` of the ranks of the leaves below
it.  A node at level ``l`` lies in the bucket ``low div fanout^l`` of its group,
so an ancestor is found by an equi-join on group and bucket with the test that
its interval contains the node's; the siblings of a node are the children of its
parent whose intervals make up the difference of the two.  One tree stands per
language, and one over the roots of these.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from salesloom.llm.common import stored

# The columns of a leaf in the order in which they are hashed.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SLOT_BITS = 33


@dataclass(frozen=True)
class Settings:
    """``fanout`` consecutive nodes have one parent."""

    fanout: int = 8


def _framed(value: Column) -> Column:
    """A value so that no two rows of values run together to the same text: its bytes, ``:``, itself; ``-`` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**columns: Column) -> Column:
    """The digest of a document given its columns by name."""
    return F.sha2(F.concat(*[_framed(columns[name]) for name in LEAF_COLUMNS]), 256)


def folded_case(text: Column) -> Column:
    """The text with A to Z in lower case, all else as it is."""
    return F.translate(text.cast("string"), _UPPER, _LOWER)


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``rank`` (from 0) by ``order`` within ``grp``, and ``n``, the size of the group.

    The rows are sorted over all tasks, so a group may be of any size.  The
    number of offsets is that of slices and groups together.
    """
    slices = stored(
        rows.repartitionByRange("grp", *order)
        .sortWithinPartitions("grp", *order)
        .withColumn("slot", F.monotonically_increasing_id()),
        "manifest-order",
    ).withColumn("slice", F.shiftright("slot", _SLOT_BITS))
    by_slice = W.partitionBy("grp").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        slices.groupBy("grp", "slice")
        .agg(F.count("*").alias("rows"), F.min("slot").alias("first"))
        .withColumn("shift", F.coalesce(F.sum("rows").over(by_slice), F.lit(0)) - F.col("first"))
        .withColumn("n", F.sum("rows").over(W.partitionBy("grp")))
        .select("grp", "slice", "shift", "n")
    )
    return (
        slices.join(offsets, ["grp", "slice"])
        .withColumn("rank", F.col("slot") + F.col("shift"))
        .drop("slot", "slice", "shift")
    )


def _levels(leaves: DataFrame, fanout: int) -> list[DataFrame]:
    """The nodes of every level above the leaves, with their intervals and children.

    ``leaves`` has ``grp``, ``n``, ``rank`` and ``digest``.  A node has at most
    ``fanout`` children.  A group whose nodes have come down to one is not
    carried further, so the number of levels follows the largest group.
    """
    largest = leaves.agg(F.max("n")).first()[0] or 0
    nodes = leaves.select("grp", "n", F.col("rank").alias("low"), (F.col("rank") + 1).alias("high"), "digest")
    levels, width = [], 1
    while width < largest:
        parent = F.floor(F.col("low") / (width * fanout)).cast("long")
        grouped = (
            nodes.where(F.col("n") > width)
            .groupBy("grp", "n", parent.alias("bucket"))
            .agg(F.sort_array(F.collect_list(F.struct("low", "high", "digest"))).alias("children"))
        )
        nodes = stored(
            grouped.select(
                "grp",
                "n",
                "bucket",
                F.element_at("children", 1)["low"].alias("low"),
                F.element_at("children", -1)["high"].alias("high"),
                F.sha2(F.array_join("children.digest", ""), 256).alias("digest"),
                "children",
            ),
            "manifest-level",
        )
        levels.append(nodes)
        width *= fanout
    return levels


def _siblings(low: Column, high: Column) -> Column:
    """Digests of the parent's interval less ``[low, high)``, joined on either side."""

    def joined(keep) -> Column:
        return F.array_join(F.transform(F.filter("above.children", keep), lambda child: child["digest"]), "")

    return F.struct(
        joined(lambda child: child["high"] <= low).alias("left"),
        joined(lambda child: child["low"] >= high).alias("right"),
    )


def _attached(nodes: DataFrame, above: DataFrame, width: int) -> DataFrame:
    """Joins each node to the one above that contains it; adds its path and what hangs on the tops."""
    parents = above.select(
        F.col("grp").alias("p_grp"),
        F.floor(F.col("low") / width).cast("long").alias("p_bucket"),
        F.struct("low", "high", "children", "path", "tops").alias("above"),
    )
    low, high = nodes["low"], nodes["high"]
    inside = (low >= F.col("above.low")) & (high <= F.col("above.high"))
    bucket = F.floor(low / width).cast("long") == F.col("p_bucket")
    return nodes.join(parents, (nodes["grp"] == F.col("p_grp")) & bucket & inside).select(
        *nodes.columns, F.concat(F.array(_siblings(low, high)), "above.path").alias("path"), F.col("above.tops").alias("tops")
    )


def _with_paths(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame, fanout: int) -> DataFrame:
    """The leaves with ``path``, siblings level by level upwards, and ``tops``.

    ``tops`` has ``grp``, ``path`` and ``tops`` of the one node that is left of
    each group, at whatever level that is.
    """
    above = None
    for level in range(len(levels), -1, -1):
        nodes = levels[level - 1] if level else leaves.withColumns({"low": F.col("rank"), "high": F.col("rank") + 1})
        found = nodes.where((F.col("low") == 0) & (F.col("high") == F.col("n"))).join(tops, "grp")
        if above is not None:
            found = found.unionByName(_attached(nodes, above, fanout ** (level + 1)))
        above = found
    return above


@dataclass(frozen=True)
class Manifest:
    """``leaves``: a row per document with its ``path``, ``subroot`` and ``root``; ``levels``: the nodes of each level."""

    leaves: DataFrame
    levels: list[DataFrame]


def manifest(docs: DataFrame, carry: dict[str, Column] | None = None, settings: Settings = Settings()) -> Manifest:
    """The manifest of ``docs``.

    ``leaves`` has a row per row of ``docs``: ``doc_id``, ``leaf``, the columns
    of ``carry`` (computed from ``docs`` in the pass that hashes the leaves),
    ``rank`` within the language, ``path`` (per level the digests left and right
    in the run, joined), ``subroot`` and ``root``.  Texts are hashed whole where
    they are read and never moved.

    A null is hashed as ``-`` and an empty text as ``0:``; null ids come first,
    null languages are a tree of their own that comes first.  Rows that share
    language and id are ordered by digest, and equal rows are leaves of their
    own with equal digests.  An empty table gives no rows.  Further columns are
    not read.
    """
    texts = {name: docs[name] for name in LEAF_COLUMNS}
    rows = docs.select(
        docs["doc_id"],
        F.coalesce(F.concat(F.lit("="), docs["lang"].cast("string")), F.lit("")).alias("grp"),
        leaf_digest(**texts).alias("digest"),
        F.struct(F.lit(True).alias("_"), *[column.alias(name) for name, column in (carry or {}).items()]).alias("carried"),
    )
    leaves = _ranked(rows, ["doc_id", "digest"])
    levels = _levels(leaves, settings.fanout)
    # The one node that is left of each language is a leaf of the upper tree.
    whole = (F.col("low") == 0) & (F.col("high") == F.col("n"))
    single = leaves.where("n = 1").select("grp", "digest")
    subroots = single
    for level in levels:
        subroots = subroots.unionByName(level.where(whole).select("grp", "digest"))
    upper = _ranked(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("lang"), "digest"), ["lang"])
    upper_levels = _levels(upper, settings.fanout)
    no_path = F.array().cast("array<struct<left:string,right:string>>")
    top = upper_levels[-1] if upper_levels else upper
    roots = top.select(
        "grp", no_path.alias("path"), F.struct(F.col("digest").alias("root")).alias("tops")
    )
    tops = _with_paths(upper, upper_levels, roots, settings.fanout).select(
        F.col("lang").alias("grp"), "path", F.struct(F.col("digest").alias("subroot"), "tops.root").alias("tops")
    )
    found = _with_paths(leaves, levels, stored(tops, "manifest-subroots"), settings.fanout)
    names = list(carry or {})
    out = found.select(
        "doc_id",
        F.col("digest").alias("leaf"),
        *[F.col("carried")[name].alias(name) for name in names],
        "rank",
        "path",
        "tops.subroot",
        "tops.root",
    )
    return Manifest(out, [level.drop("bucket") for level in levels + upper_levels])


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path of siblings lead to."""
    return F.aggregate(
        path, leaf, lambda digest, run: F.sha2(F.concat(run["left"], digest, run["right"]), 256)
    )


def proof_digest(path: Column) -> Column:
    """One digest for a whole path, left to right and upwards."""
    return F.sha2(F.array_join(F.transform(path, lambda run: F.concat(run["left"], run["right"])), ""), 256)


def verified(docs: DataFrame, leaf: Column, settings: Settings = Settings()) -> DataFrame:
    """Checks documents as they are now against the manifest of ``docs``.

    ``leaf`` is the digest, from columns of ``docs``, of what is to be checked.
    Per row: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` of
    ``docs``, ``folded_root`` that ``leaf`` leads to, and whether that is the root.
    """
    found = manifest(docs, {"now": leaf}, settings).leaves
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        folded(F.col("now"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def tampered_leaf(docs: DataFrame) -> Column:
    """The digest of a document of which, by the checksum of its id, one in three has its text folded in case."""
    chosen = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 3 == 0
    text = F.when(F.coalesce(chosen, F.lit(False)), folded_case(docs["text"])).otherwise(docs["text"].cast("string"))
    return leaf_digest(**{**{name: docs[name] for name in LEAF_COLUMNS}, "text": text})
