"""Quality rules on documents and their hosts, with host rates shrunk by an empirical beta prior."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from salesloom.llm.common import ID, TEXT_HASH, WORD, let, same, stored, text_of

# The characters that count as symbols.
SYMBOLS = "[#*$%&|<>]"
HAS_WORD = "[^\\x20\\x09-\\x0D]"
WINDOW = 8

RULES = ("short", "repeats", "symbols", "dup_lines")


@dataclass(frozen=True)
class Limits:
    min_words: int = 20
    repeat_percent: int = 30
    symbol_percent: int = 10
    dup_line_percent: int = 30
    # A host fails if its shrunk rate of any rule exceeds this.
    host_rate: float = 0.5


def _covered(windows: Column) -> Column:
    """Words in windows whose hash occurs twice or more, given the hashes in order."""

    def of_sorted(pairs: Column) -> Column:
        def repeated(pair: Column, at: Column) -> Column:
            before = F.get(pairs, at - 1)["h"] == pair["h"]
            after = F.get(pairs, at + 1)["h"] == pair["h"]
            return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

        return F.sort_array(F.transform(F.filter(pairs, repeated), lambda pair: pair["at"]))

    def width(starts: Column) -> Column:
        steps = F.transform(
            starts, lambda at, n: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, n + 1) - at, F.lit(WINDOW)))
        )
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    pairs = F.sort_array(F.transform(windows, lambda h, at: F.struct(h.alias("h"), at.alias("at"))))
    return let(let(pairs, of_sorted), width)


def _repeat_words(words: Column) -> Column:
    """Words in 8-word windows found twice or more in the text, first occurrences included."""

    def of_hashes(hashes: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(1), F.size(hashes) - (WINDOW - 1)),
            lambda at: F.xxhash64(F.slice(hashes, at, WINDOW)),
        )
        return let(
            windows,
            lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(_covered(w)),
        )

    hashes = F.transform(words, lambda word: F.xxhash64(word))
    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(let(hashes, of_hashes))


def measures(text: Column) -> Column:
    """A struct of the counts the rules need, of the whole text."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(HAS_WORD))
    of_lines = let(
        lines, lambda l: F.struct(F.size(l).alias("n"), (F.size(l) - F.size(F.array_distinct(l))).alias("dup"))
    )
    of_words = let(
        F.regexp_extract_all(text, F.lit(f"({WORD})"), 1),
        lambda w: F.struct(
            F.size(w).alias("n"),
            F.aggregate(w, F.lit(0), lambda total, word: total + F.length(word)).alias("chars"),
            _repeat_words(w).alias("repeats"),
        ),
    )
    return F.struct(
        of_words.alias("words"),
        of_lines.alias("lines"),
        F.regexp_count(text, F.lit(SYMBOLS)).alias("symbols"),
    )


def document_counts(docs: DataFrame, limits: Limits = Limits(), host: str = "source") -> DataFrame:
    """Counts and rule failures per document, one row per row of ``docs``.

    Columns: the id and text hash, the host, the counts as long, and one
    ``fails_<rule>`` boolean per rule.
    """
    text = text_of(docs)
    found = docs.select(
        docs["doc_id"].alias(ID), F.xxhash64(docs["text"]).alias(TEXT_HASH), docs[host].alias("host"), measures(text).alias("m")
    )
    counts = found.select(
        ID,
        TEXT_HASH,
        "host",
        F.col("m.words.n").cast("long").alias("n_words"),
        F.col("m.words.chars").cast("long").alias("word_chars"),
        F.col("m.symbols").cast("long").alias("n_symbols"),
        F.col("m.lines.dup").cast("long").alias("n_dup_lines"),
        F.col("m.lines.n").cast("long").alias("n_lines"),
        F.col("m.words.repeats").cast("long").alias("n_repeat_words"),
    )
    return counts.select(
        "*",
        (F.col("n_words") < limits.min_words).alias("fails_short"),
        (100 * F.col("n_repeat_words") > limits.repeat_percent * F.col("n_words")).alias("fails_repeats"),
        (100 * F.col("n_symbols") > limits.symbol_percent * F.col("n_words")).alias("fails_symbols"),
        (100 * F.col("n_dup_lines") > limits.dup_line_percent * F.col("n_lines")).alias("fails_dup_lines"),
    )


def _shrunk(rule: str, spread: Row) -> Column:
    """The posterior mean of a host's failure rate."""
    mean, var = spread[f"mean_{rule}"] or 0.0, spread[f"var_{rule}"] or 0.0
    strength = max(mean * (1 - mean) / var - 1, 1.0) if var > 0 else 1.0
    return (F.col(f"f_{rule}") + mean * strength) / (F.col("n") + strength)


def host_verdicts(counts: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Per host: its documents, the shrunk failure rate of each rule, and whether the host fails.

    The beta prior of a rule has the mean and variance of the hosts' raw rates
    (method of moments).  Without a usable variance (one host, equal rates) the
    prior weighs as much as one document.  Documents without a host are not judged.
    """
    hosts = (
        counts.where("host is not null")
        .groupBy("host")
        .agg(
            F.count("*").alias("n"),
            *[F.sum(F.col(f"fails_{rule}").cast("long")).alias(f"f_{rule}") for rule in RULES],
        )
    )
    raw = {rule: F.col(f"f_{rule}") / F.col("n") for rule in RULES}
    spread = hosts.agg(
        *[F.avg(rate).alias(f"mean_{rule}") for rule, rate in raw.items()],
        *[F.var_samp(rate).alias(f"var_{rule}") for rule, rate in raw.items()],
    ).first()
    shrunk = hosts.select("host", "n", *[_shrunk(rule, spread).alias(f"rate_{rule}") for rule in RULES])
    worst = F.greatest(*[F.col(f"rate_{rule}") for rule in RULES])
    return shrunk.select("*", (worst > limits.host_rate).alias("host_failed"))


def judged(docs: DataFrame, limits: Limits = Limits(), host: str = "source") -> DataFrame:
    """Counts, base failure, host verdict and decision per row of ``docs``.

    ``base_failed``: too few words or too many repeated ones; such a document
    goes.  On a host that fails, the other rules bind as well: a document there
    stays only if it fails none of them.  Null and empty texts have no words and
    fail; null hosts are not judged; equal rows get equal verdicts; an empty
    table gives no rows; further columns of ``docs`` are not read.
    """
    counts = stored(document_counts(docs, limits, host), "document-counts")
    hosts = host_verdicts(counts, limits).select("host", *[f"rate_{rule}" for rule in RULES], "host_failed")
    base = F.col("fails_short") | F.col("fails_repeats")
    soft = F.col("fails_symbols") | F.col("fails_dup_lines")
    host_failed = F.coalesce(F.col("host_failed"), F.lit(False))
    return (
        counts.join(hosts, "host", "left")
        .withColumn("base_failed", base)
        .withColumn("host_failed", host_failed)
        .withColumn("kept", ~base & ~(host_failed & soft))
    )


def keep_good(docs: DataFrame, limits: Limits = Limits(), host: str = "source") -> DataFrame:
    """The rows of ``docs`` that ``judged`` keeps, all columns as they are."""
    keys = (
        judged(docs, limits, host)
        .where(~F.col("kept"))
        .select(ID, TEXT_HASH)
    )
    return docs.join(
        keys, same(docs["doc_id"], keys[ID]) & (F.xxhash64(docs["text"]) == keys[TEXT_HASH]), "left_anti"
    )
