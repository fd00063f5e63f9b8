"""Manifest, periodic runs and SimHash against plain versions in memory, on odd rows as well."""

import hashlib
import random
from fractions import Fraction
from zlib import crc32

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from salesloom.llm import merkle_manifest, periodic_runs, queries, simhash_dedup
from salesloom.llm.suffix_runs import Limits

draw = random.Random(11)
VOCABULARY = ["".join(draw.choices("abcdefghijklmnop", k=draw.randint(2, 8))) for _ in range(300)]


def prose(words, seed):
    return " ".join(random.Random(seed).choices(VOCABULARY, k=words))


BASE = prose(400, 1)
ROWS = [
    (1, BASE, "en"),
    (2, BASE + " once", "en"),
    (3, BASE.upper(), "en"),
    (4, None, "en"),
    (5, "", "de"),
    (6, " \t\n", None),
    (7, "one two", None),
    (8, "One  TWO", "fr"),
    (9, prose(25_000, 2), "en"),
    (10, "\n".join([prose(9, 3)] * 12) + "\n" + prose(50, 4), "de"),
    (11, "x " * 70, "en"),
    (12, "é 数字 😀  x\n\n \t y", "en"),
    (13, prose(60, 5), "en"),
    (13, prose(60, 5), "en"),
    (13, prose(60, 6), "en"),
    (None, BASE, "en"),
    (None, "lone words of nobody else here", None),
    *[(100 + i, prose(40 + i, 50 + i).title(), random.Random(i).choice(["en", "en", "de", None])) for i in range(90)],
]
COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "grp string, rank int, digest string, path string, print long, anchor int, runs string, words int"
)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, g, f"src{(i or 0) % 3}" if i != 7 else None, None if t is None else len(t), "x", 1, "y", "z", 5, 6, "r", 2)
            for i, t, g in ROWS]
    return spark.createDataFrame(rows, COLUMNS).repartition(5)


def test_empty_tables_give_no_rows(docs):
    none = docs.limit(0)
    assert merkle_manifest.verified(none, merkle_manifest.tampered_leaf(none)).isEmpty()
    assert periodic_runs.periodic_runs(periodic_runs.with_planted_runs(none)).isEmpty()
    assert simhash_dedup.near_duplicates(none).isEmpty()


# Manifest


def digest(*values):
    return hashlib.sha256("".join(values).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    values = (doc_id, source, lang, n_chars, text)
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes, fanout):
    """The root of digests in order, and per leaf its siblings by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, path in enumerate(paths):
            start = at[i] // fanout * fanout
            run = nodes[start : start + fanout]
            path.append(("".join(run[: at[i] - start]), "".join(run[at[i] - start + 1 :])))
            at[i] //= fanout
        nodes = [digest(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
    return nodes[0], paths


def plain_manifest(rows, fanout=8):
    trees = {}
    for row in rows:
        trees.setdefault(row["lang"], []).append((row, leaf_of(*[row[c] for c in merkle_manifest.LEAF_COLUMNS])))
    langs = sorted(trees, key=lambda g: (g is not None, (g or "").encode()))
    roots, paths = {}, {}
    for lang in langs:
        trees[lang].sort(key=lambda x: (x[0]["doc_id"] is not None, x[0]["doc_id"] or 0, x[1]))
        roots[lang], paths[lang] = climb([leaf for _, leaf in trees[lang]], fanout)
    root, upper = climb([roots[lang] for lang in langs], fanout)
    out = []
    for lang, above in zip(langs, upper):
        for (row, leaf), path in zip(trees[lang], paths[lang]):
            path, text, doc = path + above, row["text"], row["doc_id"]
            if text is not None and doc is not None and crc32(str(doc).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            now = leaf_of(doc, row["source"], lang, row["n_chars"], text)
            for left, right in path:
                now = digest(left, now, right)
            proof = digest(*[left + right for left, right in path])
            out.append((doc, leaf, roots[lang], root, proof, now, now == root))
    return sorted(out, key=str)


@pytest.mark.parametrize("fanout", [8, 2])
def test_manifest_equals_plain_trees(docs, fanout):
    settings = merkle_manifest.Settings(fanout)
    found = merkle_manifest.verified(docs, merkle_manifest.tampered_leaf(docs), settings)
    want = plain_manifest([r.asDict() for r in docs.collect()], fanout)
    assert sorted(map(tuple, found.collect()), key=str) == want
    assert not all(row[-1] for row in want) and any(row[-1] for row in want)


def test_manifest_of_one_document_and_of_one_language(docs):
    for chosen in (docs.where("doc_id = 7"), docs.where("lang = 'de'")):
        found = merkle_manifest.verified(chosen, merkle_manifest.tampered_leaf(chosen))
        assert sorted(map(tuple, found.collect()), key=str) == plain_manifest([r.asDict() for r in chosen.collect()])


def test_manifest_intervals_nest(docs):
    made = merkle_manifest.manifest(docs)
    assert made.leaves.count() == len(ROWS)
    for level in made.levels:
        for node in level.collect():
            edges = [(child["low"], child["high"]) for child in node["children"]]
            assert [node["low"], *[high for _, high in edges]] == [*[low for low, _ in edges], node["high"]]
            assert 1 <= len(edges) <= 8


# Periodic runs


def plain_runs(words, limits):
    found = {}
    for period in range(1, len(words) // limits.exponent + 1):
        at = 0
        while at + period < len(words):
            if words[at] == words[at + period]:
                start = at
                while at + period < len(words) and words[at] == words[at + period]:
                    at += 1
                length = at + period - start
                if length >= limits.length and length >= limits.exponent * period:
                    found.setdefault((start, length), period)
            at += 1
    return sorted((start, length, period) for (start, length), period in found.items())


def described(doc, words, limits=Limits()):
    found = plain_runs(words, limits)
    gone = {place for start, length, period in found for place in range(start + period, start + length)}
    top = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
    listed = "".join("%d,%d,%d\n" % run for run in found)
    kept = b" ".join(word for place, word in enumerate(words) if place not in gone)
    return (
        doc, len(found), *top, 1000 * top[1] // top[2] if found else None,
        hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest(),
    )


def planted(doc, text):
    words = (text or "").encode().split()
    h = 1 if doc is None else crc32(str(doc).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


RUN_COLUMNS = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def test_runs_of_planted_documents(docs, rows_of):
    found = periodic_runs.periodic_runs(periodic_runs.with_planted_runs(docs))
    # The long random text has no run unless one is planted, which this id has not.
    assert crc32(b"9") % 10
    want = [described(i, planted(i, t) if i != 9 else []) for i, t, _ in ROWS]
    got = rows_of(found.where("doc_id is null or doc_id <> 9"), *RUN_COLUMNS)
    assert got == sorted([w for w in want if w[0] != 9], key=str)
    long = found.where("doc_id = 9").first()
    assert (long.n_runs, long.collapsed_sha256) == (0, hashlib.sha256(ROWS[8][1].encode()).hexdigest())
    assert sum(w[1] > 0 for w in want) >= 6


def test_runs_of_many_sequences_equal_plain_ones():
    rng, total = random.Random(3), 0
    for _ in range(150):
        words = []
        for _ in range(rng.randint(1, 6)):
            size, kinds = rng.randint(0, 110), rng.choice([1, 2, 3, 5, 50])
            line = [b"%d" % rng.randrange(kinds) for _ in range(size)]
            if size and rng.random() < 0.6:
                a = rng.randrange(size)
                p = 1 + (size - a) // rng.randint(3, 10)
                line = line[:a] + [line[a + (i - a) % p] for i in range(size - a)] + line[: rng.randint(0, size)]
            words.append(line)
        limits = rng.choice([Limits(), Limits(4, 2), Limits(6, 3), Limits(2, 2)])
        want = [plain_runs(line, limits) for line in words]
        assert [list(map(tuple, rows.tolist())) for rows in periodic_runs.runs_of_all(words, limits)] == want
        total += sum(map(len, want))
    assert total > 1000


def test_overlap_bounds_every_run():
    assert Limits().overlap == 16
    for limits in (Limits(), Limits(10, 2), Limits(1, 3)):
        sizes = [(length, q) for q in range(1, 200) for length in range(limits.exponent * q, 700) if length >= limits.length]
        assert min(length - q for length, q in sizes) == limits.overlap


def test_collapsed_text_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "WORDS_AT_ONCE", 50)
    made = spark.createDataFrame([(1, "a b " * 30 + "c"), (2, "d e f"), (3, None), (4, "g " * 500)], "doc_id long, text string")
    found = {r.doc_id: r for r in periodic_runs.periodic_runs(made, with_text=True).collect()}
    assert [found[i].text for i in (1, 2, 3, 4)] == ["a b c", "d e f", "", "g"]
    assert [tuple(run) for run in found[1].runs] == [(0, 60, 2)]
    assert found[4].exponent_milli == 500_000


# SimHash


def plain_print(text):
    words = (text or "").encode().lower().split()
    width = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + width]), 42) for i in range(len(words) - width + 1)] if words else []
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """The least member of each value's group, links being at most 2 bits apart."""
    values = sorted(set(prints))
    root = {v: v for v in values}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {v: top(v) for v in values}


def test_fingerprint_is_the_spark_hash(spark):
    hashes = spark.createDataFrame([("one two three",)], "x string").select(F.xxhash64("x")).first()[0]
    assert simhash_dedup.fingerprint(b"ONE  two\nthree") == hashes % (1 << 64)
    assert simhash_dedup.fingerprint(None) == simhash_dedup.fingerprint(b" \n") == 0


def test_near_duplicates(docs):
    found = simhash_dedup.near_duplicates(docs).collect()
    prints = [plain_print(t) for _, t, _ in ROWS]
    groups = plain_components(prints)
    least = {}
    for (doc, _, _), value in zip(ROWS, prints):
        if doc is not None:
            least[groups[value]] = min(doc, least.get(groups[value], doc))
    want = [(doc, "%016x" % value, least.get(groups[value])) for (doc, _, _), value in zip(ROWS, prints)]
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    assert {row.component_id for row in found if row.doc_id in (4, 5, 6)} == {4}
    assert {row.component_id for row in found if row.doc_id in (1, 2, 3)} == {1}


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def test_anchors_are_all_code_words_within_two_bits(spark):
    def syndrome(word):
        total = 0
        for place in range(1, 64):
            total ^= place * (word >> (place - 1) & 1)
        return total

    rng = random.Random(8)
    words = [0, 1, (1 << 64) - 1, 1 << 63, *[rng.getrandbits(64) for _ in range(12)]]
    table = spark.createDataFrame([(signed(w),) for w in words], "print long")
    found = table.select("print", simhash_dedup.anchors(F.col("print"), simhash_dedup._syndrome(F.col("print"))).alias("at")).collect()
    for row in found:
        word = row["print"] % (1 << 64)
        flips = [0, *[1 << i for i in range(64)], *[1 << i | 1 << j for i in range(64) for j in range(i)]]
        want = sorted(word ^ flip for flip in flips if syndrome(word ^ flip) == 0)
        assert sorted(at % (1 << 64) for at in row["at"]) == want


@pytest.mark.parametrize("spread", [6, 12, 64])
def test_links_connect_as_all_pairs_do(spark, spread):
    """Dense and thin clusters: every pair at most 2 bits apart is connected, and no link is longer."""
    rng = random.Random(spread)
    centres = [rng.getrandbits(64) for _ in range(4)]
    values = {0, *centres}
    for _ in range(350):
        value = rng.choice(centres)
        for _ in range(rng.randint(0, 5)):
            value ^= 1 << rng.randrange(spread)
        values.add(value)
    table = spark.createDataFrame([(signed(v),) for v in values], "print long")
    made = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash_dedup.links(table).collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in made)
    root = {v: v for v in values}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in made:
        x, y = sorted((top(a), top(b)))
        root[y] = x
    assert {v: top(v) for v in values} == plain_components(values)


def test_registered_queries(spark):
    """Columns of the queries over a given table."""
    folder = "/root/testdata/sf0.001"
    columns = {
        "op11_merkle_manifest": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
        "op12_periodic_runs": ["doc_id", "n_words", *RUN_COLUMNS[1:]],
        "op13_simhash_dedup": ["doc_id", "fingerprint", "component_id"],
    }
    for name, wanted in columns.items():
        assert queries.QUERIES[name](spark, folder).columns == wanted
    found = {r.doc_id: tuple(r)[1:] for r in queries.QUERIES["op13_simhash_dedup"](spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: plain_print(r.text) for r in rows}
    groups = plain_components(prints.values())
    least = {}
    for doc in sorted(prints):
        least.setdefault(groups[prints[doc]], doc)
    assert found == {doc: ("%016x" % value, least[groups[value]]) for doc, value in prints.items()}
    found = queries.QUERIES["op12_periodic_runs"](spark, folder).select(*RUN_COLUMNS).collect()
    assert sorted(map(tuple, found)) == sorted(described(r.doc_id, planted(r.doc_id, r.text)) for r in rows if r.doc_id is not None)
    found = queries.QUERIES["op11_merkle_manifest"](spark, folder).collect()
    table = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert sorted(map(tuple, found), key=str) == plain_manifest([r.asDict() for r in table])
    assert np.mean([r.verified for r in found]) > 0.5
