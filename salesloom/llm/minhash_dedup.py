"""Near-duplicate documents by b-bit MinHash over 5-word shingles, confirmed on the full sets."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.buckets import Marks, linked_components, near_enough, shared_buckets
from salesloom.llm.common import likely_among, map_arrow, stored

MASK = (1 << 64) - 1


@dataclass(frozen=True)
class Settings:
    """``bands`` of ``rows`` minima: a pair at 0.75 shares one with probability 0.99999 (1 - (1 - 0.75^5)^48).

    ``bits`` low bits of each of ``minima`` minima are kept.  A pair is checked
    on its full sets if the similarity estimated from them is at least
    ``percent`` less ``margin``, five standard errors, or if one of the sets has
    fewer than ``small`` shingles, for which the estimate is not good.  Pairs
    that differ in more of ``sketch`` parity bits than similar sets can are left
    out before, which loses no link.
    """

    words: int = 5
    percent: int = 75
    minima: int = 256
    bands: int = 48
    rows: int = 5
    bits: int = 4
    margin: int = 15
    small: int = 64
    sketch: int = 2048


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that every bit depends on all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _constants(seed: int, count: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, MASK, count, dtype=np.uint64) | np.uint64(1)


def shingles(text: str | None, words: int) -> np.ndarray:
    """Distinct hashes of the ``words``-word shingles, sorted; of fewer words one for the whole sequence."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))
    width = min(words, len(tokens))
    factors = _constants(5, words)
    total = np.full(len(hashes) - width + 1, width, np.uint64)
    for step in range(width):
        total = total + _mixed(hashes[step : len(hashes) - width + 1 + step] + factors[step]) * factors[step]
    return np.unique(_mixed(total))


def _minima(values: np.ndarray, factors: np.ndarray, addends: np.ndarray) -> np.ndarray:
    least = np.full(len(factors), MASK, np.uint64)
    for start in range(0, len(values), 2048):
        block = values[start : start + 2048, None] * factors + addends
        np.minimum(least, block.min(axis=0), out=least)
    return least


def _planes(minima: np.ndarray, bits: int) -> np.ndarray:
    """The low bits of the minima, packed: all lowest bits, then all second ones, and so on."""
    planes = [np.packbits(((minima >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8)) for bit in range(bits)]
    return np.concatenate(planes).view(np.int64)


def _sketch(values: np.ndarray, bits: int) -> np.ndarray:
    """Per bit whether an odd number of the shingles fall on it, packed.

    Shingles of both sets cancel out, so that two sketches differ in no more bits than the sets do in shingles.
    """
    places = np.bincount((values % np.uint64(bits)).astype(np.int64), minlength=bits)
    return np.packbits((places & 1).astype(np.uint8)).view(np.int64)


def _fingerprints(settings: Settings):
    factors, addends = _constants(1, settings.minima), _constants(2, settings.minima)
    # A band's key is a hash of its minima and its number.
    weights = _constants(3, settings.bands * settings.rows).reshape(settings.bands, settings.rows)
    salts = _constants(4, settings.bands)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = shingles(text.as_py(), settings.words)
                if not len(values):
                    rows.append((doc, 0, 0, 0, [], [], []))
                    continue
                least = _minima(values, factors, addends)
                bands = (_mixed(least[: weights.size].reshape(weights.shape)) * weights).sum(axis=1, dtype=np.uint64)
                key = np.array([_mixed(values).sum(), np.bitwise_xor.reduce(values)], np.uint64).view(np.int64)
                rows.append(
                    (
                        doc, len(values), int(key[0]), int(key[1]), _mixed(bands ^ salts).view(np.int64),
                        _planes(least, settings.bits), _sketch(values, settings.sketch),
                    )
                )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(column, kind)
                    for column, kind in zip(
                        zip(*rows) if rows else [[]] * 7,
                        (*[pa.int64()] * 4, *[pa.list_(pa.int64())] * 3),
                    )
                ],
                ["node", "size", "set_sum", "set_xor", "bands", "planes", "sketch"],
            )

    return of_batches


def fingerprints(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per row of ``docs``: id, set size, a 128-bit key of the set, band keys, packed low bits of the minima, sketch."""
    return map_arrow(
        docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")),
        _fingerprints(settings),
        "node long, size long, set_sum long, set_xor long, bands array<long>, planes array<long>, sketch array<long>",
    )


def _full_sets(words: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(text.as_py(), words).view(np.int64) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"]
            )

    return of_batches


def _estimate(settings: Settings, left: str, right: str) -> Column:
    """Similarity from the share of equal low bits, less what chance alone makes equal."""
    longs = settings.minima // 64

    def differing(word: int) -> Column:
        total = None
        for bit in range(settings.bits):
            place = F.lit(bit * longs + word)
            plane = F.get(f"planes{left}", place).bitwiseXOR(F.get(f"planes{right}", place))
            total = plane if total is None else total.bitwiseOR(plane)
        return F.bit_count(total)

    unequal = differing(0)
    for word in range(1, longs):
        unequal = unequal + differing(word)
    chance = 1 / (1 << settings.bits)
    return ((1 - unequal / settings.minima) - chance) / (1 - chance)


def _likely(settings: Settings, left: str, right: str) -> Column:
    likely = _estimate(settings, left, right) * 100 >= settings.percent - settings.margin
    small = F.col(f"n{left}") < settings.small
    return (small | (F.col(f"n{right}") < settings.small) | likely) & near_enough(left, right, settings.percent)


def _short(key: Column) -> Column:
    return key.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")


def _first_meeting(left: str, right: str) -> Column:
    """Whether this bucket is the first that the two share, so that a pair comes once."""
    bands = F.zip_with(f"short_bands{left}", f"short_bands{right}", lambda a, b: a == b)
    return F.get(F.col(f"short_bands{left}"), (F.array_position(bands, F.lit(True)) - 1).cast("int")) == _short(F.col("bucket"))


def _confirm(marks: DataFrame, sets: DataFrame, settings: Settings):
    """Pairs that the packed signatures let through, then decided on the full sets."""

    def confirm(pairs: DataFrame) -> DataFrame:
        likely = (
            pairs.join(marks.toDF("a", "planes_a", "sketch_a", "n_a"), "a")
            .join(marks.toDF("b", "planes_b", "sketch_b", "n_b"), "b")
            .where(_likely(settings, "_a", "_b"))
            .select("a", "b")
        )
        both = likely.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a").join(
            sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b"
        )
        return (
            both.select(
                "a",
                "b",
                (F.size("set_a") + F.size("set_b")).cast("long").alias("total"),
                F.size(F.array_intersect("set_a", "set_b")).cast("long").alias("shared"),
            )
            .where(f"100 * shared >= {settings.percent} * (total - shared)")
            .select("a", "b")
        )

    return confirm


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id`` and ``kept``.

    Documents with equal sets are one node, so that copies are compared once.
    Texts without words have an empty set and are linked with nothing.  A null
    id belongs to no group: its component is null and it is kept.  Rows that
    share an id are one node with all their links.  Texts are taken whole,
    whatever their length.  An empty table gives no rows; further columns are
    not read.
    """
    prints = stored(fingerprints(docs, settings), "document-fingerprints")
    key = ["set_sum", "set_xor", "size"]
    nodes = prints.where("node is not null and size > 0")
    # One document per distinct set; sums up before the shuffle.
    chosen = stored(nodes.groupBy(*key).agg(F.min("node").alias("node")), "document-sets")
    single = nodes.join(chosen, [*key, "node"], "left_semi")
    shared = stored(
        shared_buckets(single.select("node", "size", F.explode("bands").alias("bucket"))), "document-buckets"
    )
    wanted = stored(shared.select("node").distinct(), "documents-to-check")
    texts = likely_among(docs.select(docs["doc_id"].cast("long").alias("node"), docs["text"].cast("string").alias("text")), "node", wanted)
    sets = stored(
        map_arrow(texts.join(wanted, "node", "left_semi"), _full_sets(settings.words), "node long, shingles array<long>"),
        "document-shingles",
    )
    planes = stored(
        single.join(wanted, "node", "left_semi").select(
            "node", "planes", "sketch", F.transform("bands", _short).alias("short_bands"), F.col("size").alias("n")
        ),
        "document-planes",
    )
    marks = Marks(
        planes,
        lambda left, right: F.when(_likely(settings, left, right), _first_meeting(left, right)).otherwise(False),
    )
    confirm = _confirm(planes.select("node", "planes", "sketch", "n"), sets, settings)
    found = linked_components(shared, confirm, settings.percent, hub_rounds=1, marks=marks)
    # A node may stand for several sets if rows share its id; the component is the node's.
    groups = chosen.join(found, "node", "left").select(
        *key, "node", F.coalesce("component", "node").alias("component")
    )
    labels = groups.select(*key, F.col("component").alias("component_id"))
    labelled = prints.select(F.col("node").alias("doc_id"), *key).join(labels, key, "left")
    component = F.when(F.col("size") == 0, F.col("doc_id")).otherwise(
        F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
    )
    return labelled.select("doc_id", F.col("size").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


ROW = "__llm_row"


def drop_near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row of ``docs`` per group of near duplicates, all columns as they are.

    Rows are told apart by a number of their own, not by id: rows that share an
    id but not their text are grouped by their texts, and of repeated rows one
    stays, as of rows without an id.  The smallest id stays, a null one only if
    the group has no other.  Texts without words are in no group and stay.
    """
    rows = stored(docs.withColumn(ROW, F.monotonically_increasing_id()), "documents-numbered")
    groups = near_duplicates(rows.select(F.col(ROW).alias("doc_id"), "text"), settings).select(
        F.col("doc_id").alias(ROW), "component_id"
    )
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id").cast("long"), F.col(ROW))
    first = rows.select(ROW, "doc_id").join(groups, ROW).groupBy("component_id").agg(F.min_by(ROW, order).alias(ROW))
    return rows.join(first.select(ROW), ROW, "left_semi").select(*[f"`{c}`" for c in docs.columns])
