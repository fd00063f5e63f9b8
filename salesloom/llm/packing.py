"""Best-fit packing of token sequences into bins of several permitted lengths.

The bins are planned from the number of pieces of each length, which is a table
of at most ``max(lengths)`` numbers however many documents there are; Spark then
deals the pieces out by their rank among pieces of equal length.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from salesloom.llm.common import ID, TEXT_HASH, map_arrow, stored
from salesloom.llm.tokens import encoder, tokenizer_path


@dataclass(frozen=True)
class Settings:
    """``lengths`` are the permitted bins.

    A bin of ``n`` tokens costs ``overhead + n + n * n / attention``: a fixed
    part per sequence, work in proportion to the tokens, and attention, which
    costs as much as the rest at ``attention`` tokens.  Cheap long bins
    (``attention`` large) favour the longest, dear ones the shortest that fits.

    ``rows_per_rank``: about so many pieces of a length are ranked in one task.
    """

    lengths: tuple[int, ...] = (512, 1024, 2048, 4096)
    overhead: int = 32
    attention: int = 8192
    end_tokens: int = 1
    tokenizer: str = "byte_bpe_50k.json"
    rows_per_rank: int = 1_000_000

    def cost(self, length: int) -> float:
        return self.overhead + length + length * length / self.attention


@dataclass(frozen=True)
class Share:
    """Pieces ``first`` .. ``first + count - 1`` of a length go to bins from ``bin`` on, ``each`` to a bin."""

    length: int
    first: int
    count: int
    bin: int
    each: int
    offset: int


class _Forecast:
    """The pieces still to come that no open bin is expected to take, by length."""

    def __init__(self, counts: dict[int, int]):
        self.free = dict(counts)
        self.lengths = sorted(counts)

    def fill(self, size: int, length: int, left: int) -> dict[int, int]:
        """What best-fit decreasing would put into an empty bin of ``size`` that begins with ``length``."""
        content = {length: min(size // length, left)}
        room = size - length * content[length]
        at = min(bisect_left(self.lengths, length), bisect_right(self.lengths, room)) - 1
        while at >= 0 and room:
            other = self.lengths[at]
            content[other] = min(room // other, self.free[other])
            room -= other * content[other]
            at = min(at, bisect_right(self.lengths, room)) - 1
        return content

    def take(self, length: int, count: int) -> None:
        left = self.free.get(length, 0) - count
        if left > 0:
            self.free[length] = left
        elif length in self.free:
            del self.free[length]
            self.lengths.pop(bisect_left(self.lengths, length))


def _planned(counts: dict[int, int], sizes: list[int], settings: Settings) -> tuple[float, list[Share]]:
    """Best-fit decreasing with bins of ``sizes``: what the bins cost cut down to their contents, and the shares."""
    lengths = sorted(settings.lengths)
    # Open bins by room: (room, used) -> list of (first bin, number of bins).
    open_bins: dict[tuple[int, int], list[tuple[int, int]]] = {}
    rooms: list[tuple[int, int]] = []
    shares: list[Share] = []
    closed: Counter[int] = Counter()
    to_come = _Forecast(counts)
    next_bin = 0

    def downsized(used: int) -> float:
        return settings.cost(lengths[bisect_left(lengths, used)])

    def put(room: int, used: int, first: int, bins: int) -> None:
        if not bins:
            return
        if not room:
            closed[used] += bins
            return
        if (room, used) not in open_bins:
            open_bins[room, used] = []
            insort(rooms, (room, used))
        open_bins[room, used].append((first, bins))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(rooms, (length, 0))
            if at < len(rooms):
                room, used = rooms[at]
                first, bins = open_bins[room, used].pop()
                if not open_bins[room, used]:
                    del open_bins[room, used]
                    rooms.pop(at)
                each = min(room // length, max(1, left // bins))
                bins_taken = min(bins, left)
                put(room, used, first + bins_taken, bins - bins_taken)
                taken = bins_taken * each
                shares.append(Share(length, rank, taken, first, each, used))
                put(room - each * length, used + each * length, first, bins_taken)
            else:
                best = None
                for size in sizes:
                    if size >= length:
                        content = to_come.fill(size, length, left)
                        tokens = sum(n * times for n, times in content.items())
                        each_token = downsized(tokens) / tokens
                        if best is None or each_token < best[0]:
                            best = each_token, size, content
                _, size, content = best
                each = content.pop(length)
                # As many bins as the forecast fills alike; the others look at what is left then.
                bins_taken = min([left // each, *(to_come.free[n] // times for n, times in content.items())])
                taken = bins_taken * each
                for n, times in content.items():
                    to_come.take(n, times * bins_taken)
                shares.append(Share(length, rank, taken, next_bin, each, 0))
                put(size - each * length, each * length, next_bin, bins_taken)
                next_bin += bins_taken
            rank += taken
            left -= taken
        to_come.take(length, counts[length])
    for (_, used), groups in open_bins.items():
        closed[used] += sum(bins for _, bins in groups)
    return sum(bins * downsized(used) for used, bins in closed.items()), shares


def plan(counts: dict[int, int], settings: Settings) -> list[Share]:
    """Variable-capacity best-fit over pieces of equal length at a time.

    Pieces go, longest first, to the open bins with the least room that takes
    them.  If none does, a bin is opened of the size whose expected contents,
    taken from the table of all lengths to come, cost least for each token.
    Which sizes take part is settled jointly: all of them, each single one that
    takes the longest piece, and then the best set without one size at a time
    as long as that costs less.  So no packing with bins of one size, cut down
    to their contents, is cheaper.  Ties go to the set tried first, the smaller
    size, the bin with less in it.
    """
    if not counts:
        return []
    lengths, longest = sorted(settings.lengths), max(counts)
    best, sizes = _planned(counts, lengths, settings), lengths
    for size in lengths:
        if size >= longest and len(lengths) > 1:
            tried = _planned(counts, [size], settings)
            if tried[0] < best[0]:
                best, sizes = tried, [size]
    while len(sizes) > 1:
        fewer = [[n for n in sizes if n != size] for size in sizes]
        tried = min(
            ((_planned(counts, some, settings), some) for some in fewer if some[-1] >= longest),
            key=lambda found: found[0][0],
            default=None,
        )
        if tried is None or tried[0][0] >= best[0]:
            break
        best, sizes = tried
    return best[1]


def _counted(path: str, end_tokens: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            ids = encode(batch.column(2).to_pylist())
            counts = pa.array([len(own) // 4 + end_tokens for own in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), counts], [ID, TEXT_HASH, "n_tokens"])

    return of_batches


def token_counts(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Id, text hash and tokens, the end token included, per row of ``docs``."""
    columns = docs.select(
        docs["doc_id"].cast("long"), F.xxhash64(docs["text"]), docs["text"].cast("string")
    )
    return map_arrow(
        columns,
        _counted(tokenizer_path(settings.tokenizer), settings.end_tokens),
        f"{ID} long, {TEXT_HASH} long, n_tokens long",
    )


def packed(counts: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Pieces of the sequences in ``counts`` (id, text hash, ``n_tokens``) with their bins.

    A sequence longer than the longest bin is cut: all pieces but the last fill
    a longest bin each.  Columns: ``doc_id``, ``piece`` (from 0), ``start`` (in
    the sequence), ``n_tokens``, ``bin_id``, ``bin_offset``, ``bin_tokens`` (the
    bin's contents), ``bin_length`` (the smallest permitted length that holds them).
    """
    longest = max(settings.lengths)
    pieces = (
        counts.where("n_tokens > 0")
        .withColumn("piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("n_tokens") - 1) / longest))))
        .select(
            ID,
            TEXT_HASH,
            "piece",
            (F.col("piece") * longest).alias("start"),
            F.least(F.lit(longest), F.col("n_tokens") - F.col("piece") * longest).alias("length"),
        )
    )
    pieces = stored(pieces, "pieces")
    by_length = {row["length"]: row["n"] for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    shares = plan(by_length, settings)
    spark = counts.sparkSession
    dealt = spark.createDataFrame(
        [(s.length, s.first, s.count, s.bin, s.each, s.offset) for s in shares],
        "p_length long, p_first long, p_count long, p_bin long, p_each long, p_offset long",
    )
    # Ranks among pieces of a length: within slices by hash, so that a common length is no hot key, plus the slices before.
    slices = 64 + sum(by_length.values()) // settings.rows_per_rank
    sliced = pieces.withColumn("slice", F.pmod(F.xxhash64(ID, TEXT_HASH, "piece"), F.lit(slices)))
    sizes = sliced.groupBy("length", "slice").agg(F.count("*").alias("n"))
    before = sizes.select(
        "length",
        "slice",
        (F.sum("n").over(W.partitionBy("length").orderBy("slice")) - F.col("n")).alias("before"),
    )
    in_slice = F.row_number().over(W.partitionBy("length", "slice").orderBy(ID, TEXT_HASH, "piece"))
    ranked = (
        sliced.withColumn("in_slice", in_slice)
        .join(before, ["length", "slice"])
        .withColumn("rank", F.col("before") + F.col("in_slice") - 1)
    )
    # The plan has a few rows per length up to the longest bin (under 10,000 at 4,096), however many pieces there are.
    placed = ranked.join(
        F.broadcast(dealt),
        (F.col("length") == F.col("p_length"))
        & (F.col("rank") >= F.col("p_first"))
        & (F.col("rank") < F.col("p_first") + F.col("p_count")),
    ).withColumn("nth", F.col("rank") - F.col("p_first"))
    bins = placed.select(
        F.col(ID).alias("doc_id"),
        F.col("piece").cast("long").alias("piece"),
        F.col("start").cast("long").alias("start"),
        F.col("length").cast("long").alias("n_tokens"),
        (F.col("p_bin") + F.floor(F.col("nth") / F.col("p_each"))).alias("bin_id"),
        (F.col("p_offset") + F.pmod("nth", "p_each") * F.col("length")).alias("bin_offset"),
    )
    filled = bins.withColumn("bin_tokens", F.sum("n_tokens").over(W.partitionBy("bin_id")))
    smallest = F.array_min(F.filter(F.array(*[F.lit(n).cast("long") for n in sorted(settings.lengths)]), lambda n: n >= F.col("bin_tokens")))
    return filled.withColumn("bin_length", smallest)


def pack_documents(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``packed`` for the texts of ``docs``.

    A null or empty text is its end token alone.  A null id is kept as it is;
    equal rows are packed once each; an empty table gives no bins; further
    columns are not read.
    """
    return packed(token_counts(docs, settings), settings)
