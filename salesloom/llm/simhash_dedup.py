"""Near-duplicate documents by 64-bit SimHash, linked at the anchors of a covering code.

The anchors are the words of the perfect Hamming code of length 63 with one more
free bit: 2^58 points, and every fingerprint is at most ``RADIUS`` = 1 bit from
one of them.  Of two fingerprints at most 2 bits apart some point lies within 1
bit of both, and the anchor of that point is within 1 + 1 = 2 bits of both.  So
each fingerprint goes to every anchor within the covering radius plus its half
of the threshold, 33 of them, and no link is lost.  (With the whole threshold on
either side, 3 bits, the same links would take 683 copies.)

The fingerprints at an anchor differ from it in at most 2 of 64 bits: there are
never more than 1 + 64 + 2016 of them, however large a group of copies is.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from salesloom.llm.common import map_arrow, stored
from salesloom.llm.components import components

BITS = 64
RADIUS = 1
THRESHOLD = 2
SEED = 42
WORDS = 3
# A key with more than one in SHARE of all rows is joined by broadcast; there are fewer than SHARE of them.
SHARE = 1000


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    """The SimHash of the word shingles, repeats included: a bit is set if it is in over half of the hashes."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    width = min(words, len(tokens))
    line = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    shingles = map(line.__getitem__, map(slice, starts, ends[width - 1 :].tolist()))
    count = len(tokens) - width + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, count)
    ones = np.zeros(BITS, np.int64)
    for start in range(0, count, 8192):
        block = hashes[start : start + 8192].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(text) for text in batch.column(1).to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["doc_id", "print"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id`` and ``print``, its fingerprint as a signed long."""
    return map_arrow(
        docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").cast("binary").alias("text")),
        _fingerprints,
        "doc_id long, print long",
    )


def _bit(place: Column) -> Column:
    """The word with the bit at ``place`` (from 1) set."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), (place - 1).cast("int"))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _syndrome(word: Column) -> Column:
    """Exclusive or of the places (1 to 63) of the set bits: 0 for a code word, otherwise the place to flip."""
    total = F.lit(0)
    for bit in range(6):
        places = sum(1 << (place - 1) for place in range(1, BITS) if place >> bit & 1)
        parity = F.bit_count(word.bitwiseAND(F.lit(_signed(places)))) % 2
        total = total + parity * (1 << bit)
    return total


def anchors(word: Column, syndrome: Column) -> Column:
    """The anchors within 2 bits of ``word``, as an array.

    Flips that lead to a code word are those whose places have the exclusive or
    ``syndrome``: one flip, or the pairs ``(place, place xor syndrome)``.  The
    free bit is the last one.
    """
    free = F.lit(_signed(1 << 63))
    home = F.when(syndrome == 0, word).otherwise(word.bitwiseXOR(_bit(F.greatest(syndrome, F.lit(1)))))
    firsts = F.filter(
        F.sequence(F.lit(1), F.lit(BITS - 1)), lambda place: place < place.bitwiseXOR(syndrome)
    )
    pairs = F.transform(
        firsts, lambda place: word.bitwiseXOR(_bit(place)).bitwiseXOR(_bit(place.bitwiseXOR(syndrome)))
    )
    # Of a code word no pair leads to another one, as place xor 0 is the place itself.
    return F.concat(F.array(home, home.bitwiseXOR(free)), pairs)


def links(prints: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` that connect the distinct values of ``print`` exactly as all pairs at most 2 bits apart do.

    At an anchor, those at most 1 bit from it are linked with each other, and so
    are those that differ from it in a common bit; if the anchor itself is
    there, it is linked with all.  No other two of them are 2 bits apart or
    less.  In each such class all meet its smallest value, so links grow with
    the copies and not with pairs.
    """
    near = prints.select("print", _syndrome(F.col("print")).alias("syndrome"))
    copies = near.select("print", F.explode(anchors(F.col("print"), F.col("syndrome"))).alias("anchor"))
    whole = W.partitionBy("anchor")
    shared = (
        copies.withColumn("members", F.count("*").over(whole))
        .withColumn("centre", F.max(F.col("print") == F.col("anchor")).over(whole))
        .where("members > 1")
        .withColumn("flips", F.col("print").bitwiseXOR(F.col("anchor")))
    )
    places = F.filter(
        F.sequence(F.lit(1), F.lit(BITS)), lambda place: F.col("flips").bitwiseAND(_bit(place)) != 0
    )
    # Class 0 holds all at an anchor that is present itself, else those at most 1 bit away.
    nobody = F.array().cast("array<int>")
    classes = F.when(F.col("centre"), F.array(F.lit(0))).otherwise(
        F.concat(F.when(F.bit_count("flips") == 1, F.array(F.lit(0))).otherwise(nobody), places)
    )
    members = shared.select("anchor", "centre", "print", F.explode(classes).alias("class"))
    least = F.min("print").over(W.partitionBy("anchor", "class"))
    star = F.when(F.col("centre"), F.col("anchor")).otherwise(least)
    return members.select(star.alias("a"), F.col("print").alias("b")).where("a <> b").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``fingerprint`` (16 hexadecimal digits) and ``component_id``.

    ``component_id`` is the smallest id that links of at most 2 bits reach, the
    row's own included.  Copies share a fingerprint, which is compared once.
    Null and empty texts, and texts without words, have the fingerprint 0 and
    are linked like any other; of fewer than three words the whole sequence is
    hashed.  A null id never is the smallest, so a group without any other has a
    null component; rows that share an id are told apart by their fingerprints.
    Texts are taken whole.  An empty table gives no rows; further columns are
    not read.
    """
    prints = stored(fingerprints(docs), "simhash-prints")
    nodes = stored(
        prints.groupBy("print").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")), "simhash-nodes"
    )
    found = stored(components(links(nodes.select("print"))), "simhash-components")
    rooted = nodes.join(found, nodes["print"] == found["node"], "left").select(
        "print", "least", "copies", F.coalesce("component", "print").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = stored(rooted.join(smallest, "root").select("print", "component_id", "copies"), "simhash-labels")
    return _labelled(prints, labels).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _labelled(prints: DataFrame, labels: DataFrame) -> DataFrame:
    """Joins ``labels`` to the rows; those of the most frequent fingerprints by broadcast, fewer than ``SHARE`` rows."""
    total = labels.agg(F.sum("copies")).first()[0] or 0
    is_hot = F.col("copies") * SHARE > total
    hot = F.broadcast(labels.where(is_hot).drop("copies"))
    rest = labels.where(~is_hot).drop("copies")
    spread = prints.join(hot.select("print"), "print", "left_anti").join(rest, "print")
    return prints.join(hot, "print").unionByName(spread)
