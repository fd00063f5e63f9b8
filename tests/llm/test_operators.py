"""Each operator against a brute-force version, and on nulls, ties, empty tables and clashing columns."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from salesloom.llm import (
    decontaminate,
    line_dedup,
    minhash_dedup,
    packing,
    quality_classifier,
    quality_rules,
    substring_dedup,
    token_counts,
    token_output,
    toxicity,
)
from salesloom.llm.common import ID, likely_among
from salesloom.llm.components import components
from salesloom.llm.induced_sort import Sorter

draw = random.Random(5)
VOCABULARY = ["".join(draw.choices("abcdefghijklmnop", k=draw.randint(3, 9))) for _ in range(800)]


def prose(words, seed):
    return " ".join(random.Random(seed).choices(VOCABULARY, k=words))


def changed(text, places, word="zzzz"):
    words = text.split(" ")
    for place in places:
        words[place] = word
    return " ".join(words)


BASE = prose(120, 1)
PASSAGE = prose(40, 2)
ROWS = [
    (1, BASE),
    (2, BASE),
    (3, changed(BASE, [60])),
    (4, prose(100, 3) + "\n" + PASSAGE),
    (5, prose(90, 4) + "\n" + changed(PASSAGE, [11, 25])),
    (6, None),
    (7, ""),
    (8, "one two"),
    (9, "One two"),
    (10, prose(30_000, 5)),
    (11, "\n".join([prose(12, 6)] * 6)),
    (12, "é 数字 😀  x\n\n \t y"),
    (None, BASE),
    (13, prose(60, 7)),
    (13, prose(60, 7)),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"src{(i or 0) % 2}", len(t or ""), "x", 1, True) for i, t in ROWS]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, node string, at int, kept boolean"
    )


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, PASSAGE), (2, None), (3, ""), (4, "too short"), (5, PASSAGE)], "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, int(i % 3 > 0), int(i % 7 == 0)) for i in range(1, 14)] + [(None, 1, 0), (3, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_everything_takes_an_empty_table(docs, benchmark, labels):
    none, no_labels = docs.limit(0), labels.limit(0)
    assert decontaminate.contamination(none, benchmark).isEmpty()
    assert not decontaminate.contamination(docs, benchmark.limit(0)).where("contaminated").count()
    assert token_counts.token_counts(none).isEmpty()
    assert substring_dedup.remove_repeats(none).isEmpty()
    assert quality_classifier.quality_scores(none, labels).isEmpty()
    assert {r.score for r in quality_classifier.quality_scores(docs, no_labels).collect()} == {0.5}
    assert token_output.token_round_trip(none).isEmpty()
    assert packing.pack_documents(none).isEmpty()
    assert minhash_dedup.near_duplicates(none).isEmpty()
    assert line_dedup.repeated_lines(none).isEmpty()
    assert toxicity.toxicity(none, labels).isEmpty()
    assert not toxicity.toxicity(docs, no_labels).where("toxic").count()
    assert quality_rules.judged(none).isEmpty()


def test_stages_keep_the_columns(docs, benchmark):
    for out in (
        quality_rules.keep_good(docs),
        line_dedup.dedup_lines(docs),
        minhash_dedup.drop_near_duplicates(docs),
        decontaminate.drop_contaminated(docs, benchmark),
    ):
        assert out.columns == docs.columns
        out.collect()


def test_decontamination(docs, benchmark):
    found = decontaminate.contamination(docs, benchmark).collect()
    assert sorted(r[ID] for r in found if r.contaminated) == [4, 5]
    assert all(list(r["items"]) == [1] for r in found if r.contaminated)
    assert len(found) == len(ROWS)


def test_masks_hit_all_windows_with_two_substitutions():
    from itertools import combinations

    settings = decontaminate.Settings()
    for gone in combinations(range(settings.window), 2):
        assert any(
            start + mask[-1] < settings.window and not {start + step for step in mask} & set(gone)
            for mask in settings.masks
            for start in range(settings.window)
        )


def test_masks_hit_all_allowed_substitutions_of_short_items():
    from itertools import combinations

    settings = decontaminate.Settings()
    for size in range(1, 14):
        allowed = size - -(-size * settings.percent // 100) if size >= settings.least else 0
        for gone in combinations(range(size), allowed):
            assert any(
                start + mask[-1] < size and not {start + step for step in mask} & set(gone)
                for mask in settings.masks_of(size)
                for start in range(size)
            )


def test_decontamination_finds_short_items(spark):
    items, rows = [], []
    for size in range(1, 13):
        words = [f"w{size}x{n}" for n in range(size)]
        items.append((size, " ".join(words)))
        rows.append((100 * size, " ".join(["before", *words, "after"])))
        for n in range(size):
            rows.append((100 * size + n + 1, " ".join(["before", *words[:n], "other", *words[n + 1 :], "after"])))
    items.append((50, "今日はとても良い天気"))
    rows.append((5000, "x。まあ今日はとても良い天気ですね"))
    found = decontaminate.contamination(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    wanted = {i for i, _ in rows if i == 5000 or i % 100 == 0 or i // 100 >= 8}
    assert {r[ID] for r in found if r.contaminated} == wanted


def test_decontamination_in_blocks_broadcasts_one_at_a_time(spark):
    words = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(words[i * 20 : i * 20 + 20])) for i in range(20)]
    rows = [(i, f"before {text} after" if i % 2 else "nothing of it") for i, text in items]
    docs, benchmark = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = {}
    for block in (100, 400_000):
        hits = decontaminate.overlaps(docs, benchmark, decontaminate.Settings(block=block))
        found[block] = sorted((r[ID], tuple(r["items"]), r["hits"]) for r in hits.collect())
        broadcasts = hits._jdf.queryExecution().optimizedPlan().toString().count("strategy=broadcast")
        # Of several blocks each was searched in a job before, and none is left to be broadcast with the others.
        assert broadcasts == (0 if block == 100 else 2)
    assert found[100] == found[400_000] and [r[0] for r in found[100]] == list(range(1, 20, 2))


def test_hits_do_not_carry_the_whole_document(spark):
    # 12,000 hits in 4,020 tokens: with all tokens in each hit these are 400 MB at once, and as many for the item.
    phrase = " ".join(f"p{i}" for i in range(20))
    long = " ".join([phrase] * 200 + [f"x{i}" for i in range(20)])
    docs = spark.createDataFrame([(1, long), (2, "y " * 40 + phrase), (3, "nothing")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(7, phrase), (8, "a b " + phrase)], "item_id long, text string")
    hits = decontaminate.overlaps(docs, benchmark)
    # Three masks per place, the last ones of an item only where they do not pass its end.
    found = {r[ID]: (sorted(r["items"]), r["hits"]) for r in hits.collect()}
    assert set(found) == {1, 2} and found[1][0] == found[2][0] == [7, 8]
    assert found[1][1] == 200 * found[2][1]
    lines = hits._jdf.queryExecution().optimizedPlan().toString().splitlines()
    checked = next(i for i, line in enumerate(lines) if "Filter" in line and "aggregate(" in line)
    assert "Generate inline" in lines[checked + 1]
    at = lines[checked + 1].index("[", lines[checked + 1].index("]"))
    assert "doc_tokens" in lines[checked + 1][at:] and "Generate" in "".join(lines[checked + 2 :])


def test_token_counts(docs):
    from tokenizers import Tokenizer, models, pre_tokenizers

    pieces = token_counts.vocabulary(token_counts.tokenizer_path(token_counts.Settings().model))
    exact = Tokenizer(models.Unigram(pieces, 0, True))
    exact.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always")
    want = sorted((str(i), len(exact.encode(t or "", add_special_tokens=False).ids)) for i, t in ROWS)
    assert sorted((str(r.doc_id), r.n_tokens) for r in token_counts.token_counts(docs).collect()) == want


def test_unigram_ties_go_to_the_longer_last_piece():
    counter = token_counts.UnigramCounter([("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁", -1.0), ("▁a", -2.0)])
    assert counter.word("▁ab") == (2, -3.0)


def brute_repeats(rows, length=50):
    first = {}
    for doc, text in rows:
        data = (text or "").encode()
        for at in range(len(data) - length + 1):
            part = data[at : at + length]
            if doc is not None and first.get(part, doc) >= doc:
                first[part] = doc
    for doc, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            if doc is not None and first[data[at : at + length]] < doc:
                gone[at : at + length] = b"\1" * length
        kept = bytes(c for c, g in zip(data, gone) if not g)
        yield str(doc), len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()


def test_anchor_bitmap_grows_with_the_shared_anchors(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "ANCHOR_BITS", 15)
    rng, settings = np.random.default_rng(3), substring_dedup.Settings()
    both, one = [rng.integers(0, 256, size, np.uint8).tobytes() for size in (100_000, 100_000)]
    docs = spark.createDataFrame([(bytearray(both),), (bytearray(both + one),)], "data binary")
    bitmap = substring_dedup._shared_anchors(docs, settings)
    assert len(bitmap) > 1 << 12

    def passed(text):
        found = [anchors for _, anchors, _, _ in substring_dedup.stretches(*substring_dedup._flat(pa.array([text])), settings)]
        return substring_dedup._in_bitmap(bitmap, np.concatenate(found))

    assert passed(both).all() and passed(one).mean() < 0.1
    assert substring_dedup._anchor_bits(0) == 15 and substring_dedup._anchor_bits(1 << 40) == substring_dedup.MOST_ANCHOR_BITS


def test_substring_dedup_clears_what_is_used_up(spark, docs):
    from salesloom.session import checkpoint_root
    from salesloom.sources import storage

    root = checkpoint_root(spark)
    before = set(storage.names_in(spark, root))
    assert substring_dedup.remove_repeats(docs).count() == len(ROWS)
    left = set(storage.names_in(spark, root)) - before
    assert not [name for name in left if name.startswith(("stretches", "shared-anchors"))]


@pytest.mark.parametrize("hot", [20_000, 1])
def test_substring_dedup(docs, hot):
    settings = substring_dedup.Settings(hot=hot, queue_rows=1000)
    found = substring_dedup.remove_repeats(docs, settings).collect()
    assert sorted((str(r[0]), *r[1:5]) for r in found) == sorted(brute_repeats(ROWS))


def test_stretches_cover_each_string_once_whatever_texts_stand_before():
    r = random.Random(6)
    common = bytes(r.choices(b"abc ", k=200))
    texts = [bytes(r.choices(b"abc ", k=r.choice([0, 1, 49, 50, 300]))) for _ in range(60)]
    texts = [t + common[r.randint(0, 40) :] if r.random() < 0.5 else t for t in texts] + [bytes(r.choices(b"ab", k=90_000))]
    settings = substring_dedup.Settings()
    anchors, starts = defaultdict(set), Counter()
    for order in (texts, texts[::-1]):
        data, edges = substring_dedup._flat(pa.array([None, *order], pa.binary())[1:])
        for stretch in substring_dedup.stretches(data, edges, settings):
            for owner, anchor, first, last in zip(*[column.tolist() for column in stretch]):
                assert edges[owner] <= first <= last <= edges[owner + 1] - settings.length
                for start in range(first, last + 1):
                    anchors[data[start : start + settings.length].tobytes()].add(anchor)
                    starts[order[owner], start - int(edges[owner])] += 1
    assert all(len(found) == 1 for found in anchors.values())
    # Once in either order, of each copy of a text.
    copies = Counter(texts)
    assert starts == {(t, i): 2 * copies[t] for t in copies for i in range(len(t) - settings.length + 1)}


def test_only_stretches_that_share_their_anchor_are_sorted(monkeypatch):
    sorted_bytes = []
    monkeypatch.setattr(
        substring_dedup, "Sorter", lambda text, *rest: sorted_bytes.append(len(text)) or Sorter(text, *rest)
    )
    common = bytes(range(65, 65 + 55))
    rows = [
        (1, b"x" * 60, 4, 9, 11, 0),  # alone, in two documents
        (2, b"y" * 60, 5, 5, 12, 0),  # alone, in one
        (3, common + b"!", 3, 3, 13, 0),
        (3, b"?" + common, 2, 7, 14, 0),
        (4, b"z" * 50, 6, 8, 15, 30),  # a single string, cut out of a stretch
    ]
    names = ["shard", "part", "least", "most", "whole", "offset"]
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
    batches = [
        pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*part), kinds)], names) for part in (rows[:3], rows[3:])
    ]
    find = substring_dedup._first_documents(substring_dedup.Settings())
    found = [tuple(r.values()) for batch in find(iter(batches)) for r in batch.to_pylist()]
    assert sorted(found) == [(11, 0, 10, 4), (13, 0, 5, 2), (14, 0, 6, 2), (15, 30, 30, 6)]
    assert sorted_bytes == [2 * (56 + 1)]


def test_induced_sort():
    for trial in range(300):
        r = random.Random(trial)
        horizon, symbols = r.choice([3, 10, 50]), r.choice([1, 2, 3, 256])
        strings = [[r.randint(1, symbols) for _ in range(r.randint(1, 30))] for _ in range(r.randint(1, 8))]
        strings += strings[:1] * r.randint(0, 2)
        text = [c for s in strings for c in [*s, 0]]
        places, prefixes = Sorter(np.array(text, np.uint16), horizon, limit=r.choice([5, 10**6]))()
        keys = {i: text[i : min(i + horizon, text.index(0, i))] for i in range(len(text)) if text[i]}
        assert sorted(places.tolist()) == sorted(keys)
        order = [keys[i] for i in places.tolist()]
        assert order == sorted(order)
        for a, b, prefix in zip(order, order[1:], prefixes.tolist()[1:]):
            assert prefix == next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_quality_classifier(spark):
    rows, marks = [], []
    for i in range(600):
        good = i % 3 > 0
        text = prose(40, i) + "."
        rows.append((i, text if good else text.replace(" ", " ### ")))
        marks.append((i, int(good), 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    found = quality_classifier.quality_scores(docs, marks).collect()
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(600) if crc32(str(i).encode()) % 5 == 0}
    assert sum(r.predicted == (r.doc_id % 3 > 0) for r in held) > 0.95 * len(held)


def test_isotonic():
    fit = quality_classifier.isotonic(np.ones(5), np.array([0.1, 0.5, 0.3, 0.4, 0.9]))
    assert np.allclose(fit, [0.1, 0.4, 0.4, 0.4, 0.9])


def test_token_output(docs):
    from tokenizers import Tokenizer

    exact = Tokenizer.from_file(token_output.tokenizer_path("byte_bpe_50k.json"))
    want, start = [], 0
    for doc, text in sorted(ROWS, key=lambda row: (row[0] is not None, row[0] or 0)):
        ids = exact.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((doc, start, len(ids), crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = [tuple(r) for r in token_output.token_round_trip(docs, token_output.Settings(shard_documents=4)).collect()]
    assert sorted(found, key=lambda r: r[1]) == want


def test_encoder_equals_the_library():
    from tokenizers import Tokenizer

    from salesloom.llm.tokens import TextEncoder

    path = token_output.tokenizer_path("byte_bpe_50k.json")
    exact, fast = Tokenizer.from_file(path), TextEncoder(path, most=200, stretch=7)
    parts = [" ", "  ", "\n", "\t", "\r\n", "\x0b", "\x1c", "\xa0", "\xad", "a", "The", "'s", "'LL", "''", "12", "3.5"]
    parts += ["<|endoftext|>", "<|", "|>", "é", "Àß", "×", "÷", "ÿ", "数字", "😀", "...", "-", "it's", "ſ", "\x00"]
    r = random.Random(4)
    for _ in range(10):
        texts = ["".join(r.choices(parts, k=r.randint(0, 12))) for _ in range(400)]
        want = [exact.encode(text, add_special_tokens=False).ids for text in texts]
        assert [np.frombuffer(ids, "<u4").tolist() for ids in fast(texts)] == want


def test_read_one_document(spark, docs, tmp_path):
    settings = token_output.Settings(shard_documents=4)
    shards = token_output.write_token_files(docs.where("doc_id = 1"), str(tmp_path), settings).collect()
    shard = next(r.shard for r in shards if r.documents)
    assert token_output.read_document(str(tmp_path), shard, 0, "<u2").tolist()[-1] == 2


def test_packing(spark, docs):
    settings = packing.Settings(lengths=(64, 128, 256))
    pieces = packing.pack_documents(docs, settings).collect()
    bins, places = defaultdict(int), defaultdict(list)
    for r in pieces:
        bins[r.bin_id] += r.n_tokens
        places[r.bin_id].append((r.bin_offset, r.bin_offset + r.n_tokens))
    counts = Counter(str(r[ID]) for r in packing.token_counts(docs, settings).collect() for _ in range(r.n_tokens))
    packed = Counter()
    for r in pieces:
        packed[str(r.doc_id)] += r.n_tokens
    assert packed == counts
    for r in pieces:
        assert r.bin_tokens == bins[r.bin_id] <= r.bin_length == min(n for n in settings.lengths if n >= bins[r.bin_id])
    for spans in places.values():
        assert sorted(spans)[0][0] == 0 and all(a[1] == b[0] for a, b in zip(sorted(spans), sorted(spans)[1:]))


def test_packing_plan_places_each_piece_once():
    for trial in range(50):
        r = random.Random(trial)
        settings = packing.Settings(lengths=(16, 32, 64))
        counts = {n: r.randint(1, 30) for n in r.sample(range(1, 65), 20)}
        filled, placed = defaultdict(int), Counter()
        for share in packing.plan(counts, settings):
            for rank in range(share.count):
                filled[share.bin + rank // share.each] += share.length
                placed[share.length, share.first + rank] += 1
        assert max(filled.values()) <= 64 and set(placed.values()) == {1}
        assert Counter(length for length, _ in placed) == Counter(counts)


def test_equal_rows_span_shards_and_left_over_files_mean_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(5, "same words here")] * 60 + [(4, "a"), (6, None)], "doc_id long, text string")
    folder, settings = str(tmp_path), token_output.Settings(shard_documents=8)
    shards = [r for r in token_output.write_token_files(rows, folder, settings).collect() if r.documents]
    assert len(shards) >= 4 and max(r.documents for r in shards) <= 30
    (tmp_path / "shard-00000-lost.bin").write_bytes(b"cut off")
    found = sorted(token_output.read_token_files(spark, folder, settings).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == [4, *[5] * 60, 6]
    assert [r.start for r in found] == [sum(r.n_tokens for r in found[:n]) for n in range(62)]


def bins_of(shares, lengths):
    """Bins by the smallest permitted length that holds their contents."""
    used = defaultdict(int)
    for share in shares:
        for rank in range(share.count):
            used[share.bin + rank // share.each] += share.length
    return Counter(min(n for n in lengths if n >= tokens) for tokens in used.values())


def one_size(counts, size):
    """Best-fit decreasing, piece by piece, into bins of one size: what each bin holds."""
    bins = []
    for length in sorted((n for n, times in counts.items() for _ in range(times)), reverse=True):
        fitting = [at for at, used in enumerate(bins) if used + length <= size]
        if fitting:
            bins[max(fitting, key=bins.__getitem__)] += length
        else:
            bins.append(length)
    return bins


@pytest.mark.parametrize("attention", [64, 128, 1_000_000])
def test_packing_costs_no_more_than_bins_of_one_size(attention):
    settings = packing.Settings(lengths=(16, 32, 64), overhead=2, attention=attention)
    cheaper = 0
    for trial in range(20):
        r = random.Random(trial)
        counts = {n: r.randint(1, 30) for n in r.sample(range(1, 65), 20)}
        cost = sum(settings.cost(n) * times for n, times in bins_of(packing.plan(counts, settings), settings.lengths).items())
        single = sum(settings.cost(min(n for n in settings.lengths if n >= used)) for used in one_size(counts, 64))
        assert cost <= 1.02 * single
        cheaper += cost < single
    assert attention > 1000 or cheaper > 10


def test_packing_uses_all_sizes_where_that_costs_less():
    settings = packing.Settings()
    r = random.Random(8)
    counts = Counter(min(4096, int(r.lognormvariate(6.3, 1)) + 1) for _ in range(5000))
    found = bins_of(packing.plan(counts, settings), settings.lengths)
    assert set(found) == set(settings.lengths)
    single = bins_of(packing._planned(counts, [4096], settings)[1], settings.lengths)
    costs = [sum(settings.cost(n) * times for n, times in bins.items()) for bins in (found, single)]
    assert costs[0] < 0.95 * costs[1]
    assert sum(n * times for n, times in found.items()) < 1.01 * sum(n * times for n, times in counts.items())


def shingle_set(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_groups(rows):
    sets = {i: shingle_set(t) for i, t in rows if i is not None}
    group = {i: i for i in sets}
    again = True
    while again:
        again = False
        for a in sets:
            for b in sets:
                shared = len(sets[a] & sets[b])
                if shared and 100 * shared >= 75 * len(sets[a] | sets[b]) and group[a] != group[b]:
                    group[a] = group[b] = min(group[a], group[b])
                    again = True
    return sets, group


def test_minhash_dedup(spark):
    rows = list(ROWS)
    for family in range(4):
        text = prose(200, 100 + family)
        rows += [(1000 + 50 * family + n, changed(text, random.Random(n).sample(range(200), n))) for n in range(12)]
    sets, group = brute_groups(rows)
    found = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), group[r.doc_id])
            assert r.kept == (r.doc_id == r.component_id)


def test_line_dedup(spark):
    long_line = prose(60, 50)
    rows = [
        (1, f"{long_line}\nshort one\n\n{prose(30, 51)}"),
        (2, f"{changed(long_line, [30])}\nshort one\n\nother"),
        (3, f"{prose(25, 52)}\nshort two\nshort two"),
        (4, long_line),
        (5, None),
        (6, ""),
        (7, " \n\t"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    removed = {r[ID]: list(r.removed) for r in line_dedup.repeated_lines(docs).collect()}
    assert removed == {1: [], 2: [0, 1], 3: [2], 4: [0], 5: [], 6: [], 7: []}
    texts = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert texts[2] == "\nother" and 4 not in texts and texts[5] is None and texts[7] == " \n\t"


def test_minhash_dedup_loses_no_pair_at_the_threshold(spark):
    rows = []
    for pair in range(3000):
        shared = (3, 6, 30)[pair % 3]
        words = [f"p{pair}w{n}" for n in range(shared + 4 + shared // 3)]
        rows += [(2 * pair, " ".join(words[: shared + 4])), (2 * pair + 1, " ".join(words))]
    found = minhash_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.component_id == r.doc_id // 2 * 2 for r in found)


def line_shingles(line):
    coded = line.encode()
    return {coded[i : i + 12] for i in range(max(1, len(coded) - 11))}


def test_line_dedup_links_all_pairs_brute_force_does(spark):
    r = random.Random(7)
    pairs = []
    for size in [14, 15, 16, 17, 19, 20, 23, 27, 35, 60, 120, 400, 1500] * 60:
        line = "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=size))
        shared = len(line_shingles(line))
        grown = line + "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=shared // 3))
        ahead = grown[len(line) :] + line
        pairs += [(line, grown), (line, ahead)]
    for n in range(20):
        unit = "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=20 + n))
        pairs += [(unit * 4, (unit * 40)[n : 25 * len(unit)]), (unit[:1] * (60 + n) + "#", unit[:1] * (200 + n) + "#")]
    wanted = set()
    for n, (a, b) in enumerate(pairs):
        x, y = line_shingles(a), line_shingles(b)
        if a != b and 100 * len(x & y) >= 75 * len(x | y):
            wanted.add(n)
    rows = [(2 * n + side, pair[side]) for n, pair in enumerate(pairs) for side in (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    removed = {r[ID] for r in line_dedup.repeated_lines(docs).collect() if r.removed}
    lost = [pairs[n] for n in wanted if 2 * n + 1 not in removed]
    assert len(wanted) > 1000 and len(lost) <= len(wanted) // 500


def test_toxicity(spark):
    rows = [(i, prose(40, i) + (" idiot scum" if i % 4 == 0 else "")) for i in range(400)]
    docs = spark.createDataFrame([*rows, (None, None), (900, prose(50, 901) + " Scum!")], "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2, int(i % 4 == 0)) for i in range(200)], "doc_id long, quality int, toxic int")
    found = toxicity.toxicity(docs, marks).collect()
    assert len(found) == 402
    wrong = [r.doc_id for r in found if r.toxic != (r.doc_id == 900 or (r.doc_id is not None and r.doc_id % 4 == 0))]
    assert len(wrong) <= 4, wrong


def brute_counts(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [line for line in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_quality_rules(docs):
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    found = quality_rules.judged(docs).collect()
    assert sorted((str(r[ID]), *[r[n] for n in names]) for r in found) == sorted((str(i), *brute_counts(t)) for i, t in ROWS)
    for r in found:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_host_rates_are_shrunk_and_bind(spark):
    good, bad = prose(40, 60), prose(30, 61) + " ####" * 10
    rows = [(i, good if i % 10 else bad, "fine") for i in range(100)]
    rows += [(200 + i, bad if i else good, "rotten") for i in range(50)] + [(300, bad, "tiny"), (301, bad, None)]
    rows += [(400 + i, good, f"h{i % 5}") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    verdict = {r[ID]: (r.host_failed, r.kept) for r in quality_rules.judged(docs).collect()}
    assert verdict[210] == (True, False) and verdict[200] == (True, True)
    assert verdict[0] == (False, True) and verdict[301] == (False, True)


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (3, 2), (3, 4), (9, 8), (5, 5), (None, 1), (4, 1)], "a long, b long")
    assert sorted(map(tuple, components(links).collect())) == [(1, 1), (2, 1), (3, 1), (4, 1), (8, 8), (9, 8)]


def test_prefilter_loses_nothing(spark):
    rows = spark.range(50_000).selectExpr("id * 7919 as k")
    wanted = spark.range(500).selectExpr("id * 7919 * 3 as x")
    kept = likely_among(rows, "k", wanted)
    assert kept.join(wanted, kept.k == wanted.x).count() == 500 and kept.count() < 1000


def test_pipeline(spark):
    folder = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, folder)
    kept = {r.doc_id for r in out.select("doc_id").distinct().collect()}
    assert 0 < len(kept) < 200
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_duplicates", "decontamination", "packing",
    ]


def test_dropped_near_duplicates_are_never_the_only_copy(spark):
    """Shared, repeated and null ids: a text that exists once stays, and of each group one row."""
    a, b, c, d = (prose(60, seed) for seed in (21, 22, 23, 24))
    rows = [(1, a), (2, a), (2, b), (3, c), (3, c), (None, d), (None, d), (None, a), (4, changed(b, [30])), (5, None), (5, "")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    kept = minhash_dedup.drop_near_duplicates(table).collect()
    got = sorted(((r.doc_id, r.text) for r in kept), key=str)
    assert got == sorted([(1, a), (2, b), (3, c), (None, d), (5, None), (5, "")], key=str)
    assert minhash_dedup.drop_near_duplicates(table.limit(0)).isEmpty()
