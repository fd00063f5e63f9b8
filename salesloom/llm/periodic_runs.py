"""Documents that repeat a stretch of words over and over: their periodic runs, and the texts without the repeats."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import WORD, let, map_arrow
from salesloom.llm.suffix_runs import Limits, runs

# Documents are laid end to end up to this many words; a longer one is sorted by itself.
WORDS_AT_ONCE = 1 << 17
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_COLUMNS = [
    ("doc_id", pa.int64()),
    ("n_words", pa.int64()),
    ("n_runs", pa.int64()),
    ("start", pa.int64()),
    ("length", pa.int64()),
    ("period", pa.int64()),
    ("exponent_milli", pa.int64()),
    ("runs", pa.list_(_RUN)),
    ("runs_sha256", pa.string()),
    ("collapsed_sha256", pa.string()),
]
_SCHEMA = (
    "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs array<struct<start:long,length:long,period:long>>, runs_sha256 string, collapsed_sha256 string"
)


def _with_repeats(words: list[list[bytes]], window: int) -> list[int]:
    """Which of the sequences may hold a window of words twice; without that there is no run in them."""
    sizes = np.array([len(each) for each in words], np.int64)
    stops = np.cumsum(sizes)
    total = int(stops[-1]) if len(sizes) else 0
    if total < window:
        return []
    hashes = np.empty(total, np.uint64)
    for each, stop in zip(words, stops):
        hashes[stop - len(each) : stop] = np.fromiter(map(hash, each), np.int64, len(each)).view(np.uint64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.arange(total - window + 1)
    keys = np.zeros(len(starts), np.uint64)
    for step in range(window):
        keys = keys * _FACTOR + hashes[step : total - window + 1 + step]
    inside = starts + window <= stops[owner[starts]]
    keys, owner = keys[inside] ^ (owner[starts[inside]].astype(np.uint64) * _FACTOR), owner[starts[inside]]
    order = np.argsort(keys, kind="stable")
    equal = keys[order][1:] == keys[order][:-1]
    return np.unique(owner[order[1:][equal]]).tolist()


def runs_of_all(words: list[list[bytes]], limits: Limits) -> list[np.ndarray]:
    """Of each sequence of words its runs: rows of start, length and period."""
    found = [np.empty((0, 3), np.int64)] * len(words)
    chosen = _with_repeats(words, limits.overlap)
    if not chosen:
        return found
    symbols: list[int] = []
    used = 0
    for at in chosen:
        numbers: dict[bytes, int] = {}
        symbols += [used + numbers.setdefault(word, len(numbers)) for word in words[at]]
        used += len(numbers)
    sizes = np.array([len(words[at]) for at in chosen])
    stops = np.cumsum(sizes)
    rows = runs(np.array(symbols, np.int64), np.repeat(stops, sizes), limits)
    owner = np.searchsorted(stops, rows[:, 0], "right")
    edges = np.searchsorted(owner, np.arange(len(chosen) + 1))
    for each, at in enumerate(chosen):
        mine = rows[edges[each] : edges[each + 1]].copy()
        mine[:, 0] -= stops[each] - sizes[each]
        found[at] = mine
    return found


def _kept(words: list[bytes], rows: np.ndarray) -> bytes:
    """The words that no run repeats, joined by spaces."""
    if len(rows):
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, rows[:, 0] + rows[:, 2], 1)
        np.add.at(change, rows[:, 0] + rows[:, 1], -1)
        words = [words[at] for at in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
    return b" ".join(words)


def _described(doc, words: list[bytes], rows: np.ndarray, with_text: bool) -> tuple:
    listed = rows.tolist()
    top = min(listed, key=lambda row: (-Fraction(row[1], row[2]), row[0], row[2]), default=(None, None, None))
    kept = _kept(words, rows)
    return (
        doc,
        len(words),
        len(listed),
        *top,
        1000 * top[1] // top[2] if listed else None,
        [dict(zip(("start", "length", "period"), row)) for row in listed],
        hashlib.sha256("".join("%d,%d,%d\n" % tuple(row) for row in listed).encode()).hexdigest(),
        hashlib.sha256(kept).hexdigest(),
        *([kept] if with_text else []),
    )


def _search(limits: Limits, with_text: bool):
    columns = _COLUMNS + [("collapsed", pa.binary())] * with_text

    def of_block(docs: list, words: list[list[bytes]]) -> pa.RecordBatch:
        rows = map(_described, docs, words, runs_of_all(words, limits), [with_text] * len(docs))
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, (_, kind) in zip(zip(*rows), columns)], [name for name, _ in columns]
        )

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, words, held = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                # Splitting bytes without a separator cuts at space and 09 to 0D, and nowhere else.
                split = (text.as_py() or b"").split()
                if docs and held + len(split) > WORDS_AT_ONCE:
                    yield of_block(docs, words)
                    docs, words, held = [], [], 0
                docs.append(doc)
                words.append(split)
                held += len(split)
        if docs:
            yield of_block(docs, words)

    return of_batches


def periodic_runs(docs: DataFrame, limits: Limits = Limits(), with_text: bool = False) -> DataFrame:
    """Per row of ``docs``: its words, its runs, the run with the greatest exponent, and what is left without repeats.

    A run is a longest stretch of words with one period, ``limits.length`` words
    and ``limits.exponent`` periods long or more; ``runs`` lists them by start
    and period.  Of equal exponents the first run counts, of equal starts the
    shorter period.  A word goes if a run contains it after the run's first
    period; ``collapsed`` (``with_text``) is what stays, joined by spaces.

    Texts are searched whole, those of over ``WORDS_AT_ONCE`` words one at a
    time, in memory in proportion to the text.  Null and empty texts have no
    words and no runs; repeated rows and null ids are rows like others.  An
    empty table gives no rows; further columns are not read.
    """
    return map_arrow(
        docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").cast("binary").alias("text")),
        _search(limits, with_text),
        _SCHEMA + ", collapsed binary" * with_text,
    ).select("*", *([F.col("collapsed").cast("string").alias("text")] if with_text else [])).drop("collapsed")


def repeating(text: Column, checksum: Column) -> Column:
    """The text, of one in ten by ``checksum`` with its words from some place on replaced by one period again and again."""
    seed = F.floor(checksum / 10).cast("long")

    def planted(words: Column) -> Column:
        size = F.size(words).cast("long")
        start = F.pmod(seed, size)
        period = 1 + F.floor((size - start) / (3 + seed % 8)).cast("long")
        at = F.sequence(F.lit(0).cast("long"), size - 1)
        chosen = F.transform(
            at, lambda i: F.get(words, F.when(i < start, i).otherwise(start + (i - start) % period).cast("int"))
        )
        return F.when(size > 0, F.array_join(chosen, " ")).otherwise(text)

    changed = let(F.regexp_extract_all(text, F.lit(f"({WORD})"), 1), planted)
    return F.when((checksum % 10 == 0) & text.isNotNull(), changed).otherwise(text)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` of ``docs``; the texts of one id in ten, by its checksum, repeat themselves."""
    text = docs["text"].cast("string")
    return docs.select("doc_id", repeating(text, F.crc32(docs["doc_id"].cast("string").cast("binary"))).alias("text"))
