"""Benchmark decontamination with spaced seeds: overlaps are found although a few words were changed.

DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import ID, TEXT_HASH, same, stored, text_of

TOKEN = "([\\p{L}\\p{M}\\p{N}]+)"
# Thai, Lao, Myanmar, Khmer, kana, Han: no space between words.  As ranges, which are faster to match than scripts.
UNSPACED = (
    "\\u0E00-\\u0EFF\\u1000-\\u109F\\u1780-\\u17FF\\u3005-\\u3007\\u3040-\\u30FF\\u31F0-\\u31FF"
    "\\u3400-\\u4DBF\\u4E00-\\u9FFF\\uF900-\\uFAFF\\uFF66-\\uFF9F\\x{20000}-\\x{3FFFF}"
)


@dataclass(frozen=True)
class Settings:
    """An overlap is ``window`` tokens (or a whole shorter item) with ``percent`` of them equal in place.

    ``masks``: token places that a seed compares; the others are ignored.  These
    three hit every window of 13 tokens with up to two substitutions, and nine
    in ten with three.  ``short_masks``: for items under 12 tokens, by their
    length; they hit every substitution that ``percent`` allows.  Items under
    ``least`` tokens must occur word for word, and their mask is the whole item.
    ``block``: most seeds broadcast at once; more of them are searched in
    several passes over the documents.
    """

    masks: tuple[tuple[int, ...], ...] = ((0, 1, 3, 5, 6, 7), (0, 1, 2, 5, 7, 8), (0, 2, 3, 6, 7, 8))
    short_masks: tuple[tuple[tuple[int, ...], tuple[tuple[int, ...], ...]], ...] = (
        (9, ((0, 1, 2, 3, 4), (0, 1, 2, 4, 5))),
        (11, ((0, 1, 2, 4, 5), (0, 2, 3, 7, 8), (0, 4, 5, 6, 7))),
    )
    window: int = 13
    percent: int = 80
    least: int = 8
    block: int = 400_000

    def masks_of(self, size: int) -> tuple[tuple[int, ...], ...]:
        """The masks for an item of ``size`` tokens."""
        if size < self.least:
            return (tuple(range(size)),)
        return next((masks for most, masks in self.short_masks if size <= most), self.masks)


def _tokens(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits.

    Of a script without spaces each character, with its marks, is a token.
    """
    apart = F.regexp_replace(text, F.lit(f"([{UNSPACED}]\\p{{M}}*)"), F.lit(" $1 "))
    spaced = F.lower(F.when(text.rlike(f"[{UNSPACED}]"), apart).otherwise(text))
    return F.transform(F.regexp_extract_all(spaced, F.lit(TOKEN), 1), lambda token: F.xxhash64(token))


def _seeds(tokens: str, at: str, masks: list[tuple[int, ...]]) -> Column:
    """The hash of each mask laid at ``at``, null where it passes the end."""
    place = F.col(at)

    def key(mask: tuple[int, ...]) -> Column:
        values = [F.get(F.col(tokens), place + step) for step in mask]
        return F.when(values[-1].isNotNull(), F.xxhash64(F.lit(sum(1 << step for step in mask)), *values))

    return F.array(*[key(mask) for mask in masks])


def _with_seeds(df: DataFrame, tokens: str, keep: list[str], masks: list[tuple[int, ...]]) -> DataFrame:
    last = min(mask[-1] for mask in masks)
    placed = df.where(F.size(tokens) > last).select(
        *keep, tokens, F.explode(F.sequence(F.lit(0), F.size(tokens) - 1 - last)).alias(f"{tokens}_at")
    )
    return placed.select(
        *keep, tokens, f"{tokens}_at", F.explode(_seeds(tokens, f"{tokens}_at", masks)).alias("seed")
    ).where("seed is not null")


def _item_seeds(items: DataFrame, sizes: dict[int, tuple[tuple[int, ...], ...]], settings: Settings) -> DataFrame:
    """The seeds of all items, each with the masks for its length."""
    length = F.least(F.size("item_tokens"), F.lit(settings.window))
    seeds = None
    for masks in dict.fromkeys(sizes.values()):
        own = items.where(length.isin([size for size in sizes if sizes[size] == masks]))
        found = _with_seeds(own, "item_tokens", ["item"], masks).select("item", "item_tokens_at", "seed")
        seeds = found if seeds is None else seeds.unionByName(found)
    return seeds.distinct()


def benchmark_items(benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``item`` (smallest id of equal token sequences) and its token hashes, at least one."""
    tokens = benchmark.select(benchmark["item_id"].alias("item"), _tokens(text_of(benchmark)).alias("item_tokens"))
    return (
        tokens.where(F.size("item_tokens") > 0)
        .groupBy("item_tokens")
        .agg(F.min("item").alias("item"))
        .select("item", "item_tokens")
    )


def _best_overlap(settings: Settings) -> Column:
    """Most equal tokens in a window around the hit, less those needed; negative: no overlap."""
    width = F.least(F.lit(settings.window), F.size("item_tokens"))
    needed = F.when(width < settings.least, width).otherwise(F.ceil(width * settings.percent / 100).cast("int"))
    shift = F.col("doc_tokens_at") - F.col("item_tokens_at")

    def equal(start: Column) -> Column:
        return F.aggregate(
            F.sequence(start, start + width - 1),
            F.lit(0),
            lambda total, at: total
            + F.coalesce(
                (F.get(F.col("doc_tokens"), at + shift) == F.get(F.col("item_tokens"), at)).cast("int"), F.lit(0)
            ),
        )

    # A window must lie in the item and hold the place of the hit.
    first = F.greatest(F.lit(0), F.col("item_tokens_at") - width + 1)
    last = F.least(F.size("item_tokens") - width, F.col("item_tokens_at"))
    return F.array_max(F.transform(F.sequence(first, last), equal)) - needed


def _near(side: str, window: int) -> list[Column]:
    """The tokens of one side that a window over the hit can reach, and the place of the hit among them."""
    place = F.col(f"{side}_tokens_at")
    first = F.greatest(F.lit(0), place - (window - 1))
    reached = F.slice(F.col(f"{side}_tokens"), first + 1, F.lit(2 * window - 1))
    return [reached.alias(f"{side}_tokens"), (place - first).alias(f"{side}_tokens_at")]


def overlaps(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per document with an overlap: id, text hash, the sorted ``items``, and ``hits`` (confirmed seed hits).

    Only seeds and items of the benchmark are broadcast, at most
    ``settings.block`` seeds at a time; documents are never shuffled, so that a
    passage of very many of them costs no more than any other.  Null and empty
    texts on either side match nothing; null ids are ids like others; equal rows
    are one document; an empty table on either side gives no rows; columns
    beyond the ids and texts are not read.
    """
    items = stored(benchmark_items(benchmark, settings), "benchmark-items")
    # Documents get the seeds only of masks that some item needs.
    longest = F.least(F.size("item_tokens"), F.lit(settings.window))
    present = [row.n for row in items.select(longest.alias("n")).distinct().collect()] or [settings.window]
    sizes = {size: settings.masks_of(size) for size in sorted(present)}
    masks = list(dict.fromkeys(mask for own in sizes.values() for mask in own))
    seeds = stored(_item_seeds(items, sizes, settings), "benchmark-seeds")
    blocks = max(1, -(-seeds.count() // settings.block))
    tokens = docs.select(
        docs["doc_id"].alias(ID), F.xxhash64(docs["text"]).alias(TEXT_HASH), _tokens(text_of(docs)).alias("doc_tokens")
    )
    placed = _with_seeds(tokens, "doc_tokens", [ID, TEXT_HASH], masks)
    hits = None
    for block in range(blocks):
        in_block = F.pmod(F.xxhash64("item"), F.lit(blocks)) == block
        found = (
            placed.join(F.broadcast(seeds.where(in_block)), "seed")
            .join(F.broadcast(items.where(in_block)), "item")
            # All hits of a document are in memory together: they must not carry all its tokens, and a
            # generator, unlike a plain projection, keeps the condition from being tried on these.
            .select(ID, TEXT_HASH, "item", F.inline(F.array(F.struct(*_near("doc", settings.window), *_near("item", settings.window)))))
            .where(_best_overlap(settings) >= 0)
            .select(ID, TEXT_HASH, "item")
        )
        if blocks > 1:
            # A pass of its own: in one job all blocks would lie in memory side by side.
            found = stored(found, "benchmark-hits")
        hits = found if hits is None else hits.unionByName(found)
    return hits.groupBy(ID, TEXT_HASH).agg(
        F.sort_array(F.collect_set("item")).alias("items"), F.count("*").alias("hits")
    )


def contamination(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per row of ``docs``: id, text hash, whether it overlaps the benchmark, with which items, and hits."""
    found = overlaps(docs, benchmark, settings).withColumnsRenamed({ID: "found_id", TEXT_HASH: "found_hash"})
    keys = docs.select(docs["doc_id"].alias(ID), F.xxhash64(docs["text"]).alias(TEXT_HASH))
    joined = keys.join(found, same(keys[ID], found["found_id"]) & (keys[TEXT_HASH] == found["found_hash"]), "left")
    return joined.select(
        ID,
        TEXT_HASH,
        F.col("hits").isNotNull().alias("contaminated"),
        F.coalesce("hits", F.lit(0)).cast("long").alias("hits"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` without an overlap, all columns as they are."""
    found = overlaps(docs, benchmark, settings).select(
        F.col(ID).alias("__llm_found_id"), F.col(TEXT_HASH).alias("__llm_found_hash")
    )
    matched = same(docs["doc_id"], found["__llm_found_id"]) & (F.xxhash64(docs["text"]) == found["__llm_found_hash"])
    return docs.join(found, matched, "left_anti")
