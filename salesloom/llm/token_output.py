"""Token ids in binary shards: each document compressed on its own with one shared zstandard dictionary.

A folder holds ``dictionary`` (the zstandard dictionary), ``shards`` (a Parquet
table that names the files of every shard, with its totals) and per shard a
``.bin`` file (the compressed documents one after another) and an ``.idx`` file
(16 bytes of the dictionary's hash, then per document five little-endian 64-bit
integers: whether it has an id, the id, place and length of its bytes in the
``.bin`` file, number of ids).  Ids are little-endian unsigned integers of 16
bits if the vocabulary allows it, else 32.  Files that ``shards`` does not name
come from attempts that were repeated and mean nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs, parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.common import map_arrow, stored
from salesloom.llm.tokens import encoder, tokenizer_path
from salesloom.operators.ordering import running_totals
from salesloom.session import scratch_path

SHARDS = "shard int, name string, documents long, tokens long"
INDEX = 5
HASH_BYTES = 16


@dataclass(frozen=True)
class Settings:
    """``sample_documents`` bounds the different texts the dictionary is trained on, those with the least hash;
    ``sample_bytes`` bounds what is taken of each, from a place set by its hash.  Neither touches what is written.

    A shard holds about ``shard_documents`` documents or ``shard_bytes`` compressed bytes, whichever is less.
    """

    tokenizer: str = "byte_bpe_50k.json"
    end_id: int = 2
    dictionary_bytes: int = 64 * 1024
    sample_documents: int = 1_000
    sample_bytes: int = 16 * 1024
    level: int = 3
    shard_documents: int = 20_000
    shard_bytes: int = 64 * 1024 * 1024


def id_type(path: str) -> str:
    """How an id is stored."""
    return "<u2" if encoder(path).tokenizer.get_vocab_size() <= 1 << 16 else "<u4"


def _serialised(ids: bytes, end_id: int, kind: str) -> bytes:
    values = np.frombuffer(ids + end_id.to_bytes(4, "little"), "<u4")
    return values.astype(kind).tobytes()


def train_dictionary(docs: DataFrame, settings: Settings = Settings()) -> bytes:
    """A dictionary trained on the serialised ids of a bounded sample; empty if the sample is too small."""
    path = tokenizer_path(settings.tokenizer)
    # About twice as many rows as wanted are under the bound, so that no task sorts or sends more; texts are cut first.
    one_in = max(1, docs.count() // (2 * settings.sample_documents))
    text, most = docs["text"].cast("string"), F.lit(settings.sample_bytes)
    spans = (
        docs.select(text.alias("text"), F.xxhash64(text).alias("h"))
        .where(F.pmod("h", F.lit(one_in)) == 0)
        .where("length(text) > 0")
        .select("h", F.substring("text", F.pmod("h", F.greatest(F.lit(1), F.length("text") - most + 1)).cast("int") + 1, most).alias("span"))
        .groupBy("h")
        .agg(F.min("span").alias("span"))
        .orderBy("h")
        .limit(settings.sample_documents)
    )
    kind = id_type(path)
    texts = [row["span"] for row in spans.toLocalIterator()]
    samples = [
        _serialised(ids, settings.end_id, kind)[: settings.sample_bytes] for ids in encoder(path)(texts)
    ]
    try:
        return zstandard.train_dictionary(settings.dictionary_bytes, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _dictionary_hash(dictionary: bytes) -> bytes:
    return hashlib.sha256(dictionary).digest()[:HASH_BYTES]


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a folder every executor can reach."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _compressed(dictionary: bytes, settings: Settings):
    path = tokenizer_path(settings.tokenizer)

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, kind = encoder(path), id_type(path)
        compressor = zstandard.ZstdCompressor(
            level=settings.level, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        )
        for batch in batches:
            frames, counts = [], []
            for ids in encode(batch.column(2).to_pylist()):
                frames.append(compressor.compress(_serialised(ids, settings.end_id, kind)))
                counts.append(len(ids) // 4 + 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(frames, pa.binary()), pa.array(counts, pa.int64())],
                ["id", "h", "frame", "tokens"],
            )

    return compress


def _written(folder: str, dictionary: bytes):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        shard = context.partitionId()
        # Each attempt has names of its own; the rows of the one that counts tell which files are the shard.
        name = f"shard-{shard:05d}-{uuid4().hex[:12]}"
        store, root = _filesystem(folder)
        index, place, tokens = [], 0, 0
        with store.open_output_stream(f"{root}/{name}.bin") as out:
            for batch in batches:
                for doc, frame, count in zip(*(batch.column(n).to_pylist() for n in range(3))):
                    out.write(frame)
                    index.append((doc is not None, doc or 0, place, len(frame), count))
                    place += len(frame)
                    tokens += count
        with store.open_output_stream(f"{root}/{name}.idx") as out:
            out.write(_dictionary_hash(dictionary))
            out.write(np.array(index, "<i8").reshape(-1, INDEX).tobytes())
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([shard], pa.int32()),
                pa.array([name], pa.string()),
                pa.array([len(index)], pa.int64()),
                pa.array([tokens], pa.int64()),
            ],
            ["shard", "name", "documents", "tokens"],
        )

    return write


def write_token_files(docs: DataFrame, folder: str, settings: Settings = Settings()) -> DataFrame:
    """Write ``docs`` in ascending id order to shards in ``folder``; the table of shards, a row each with its totals.

    Null ids come first, equal ids in the order of their texts' hashes; a null or
    empty text is its end id alone.  Texts are taken whole, long ones as well.
    Equal rows are written once each, and any number of them may span shards.  An
    empty table makes no document.  Further columns are not read.
    """
    spark = docs.sparkSession
    dictionary = train_dictionary(docs, settings)
    store, root = _filesystem(folder)
    store.create_dir(root, recursive=True)
    with store.open_output_stream(f"{root}/dictionary") as out:
        out.write(dictionary)
    text = docs["text"].cast("string")
    # Texts are encoded where they are read; what is sorted is their compressed ids.
    frames = map_arrow(
        docs.select(docs["doc_id"].cast("long").alias("id"), F.xxhash64(text).alias("h"), text.alias("text")),
        _compressed(dictionary, settings),
        "id long, h long, frame binary, tokens long",
    )
    frames = stored(frames.withColumn("row", F.monotonically_increasing_id()), "token-frames")
    rows, size = frames.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("frame")), F.lit(0))).first()
    shards = max(1, -(-rows // settings.shard_documents), -(-size // settings.shard_bytes))
    # The stored row number parts equal rows, so that a hot id is no hot shard.
    ordered = frames.repartitionByRange(shards, "id", "h", "row").sortWithinPartitions("id", "h", "row")
    written = map_arrow(ordered.select("id", "frame", "tokens"), _written(folder, dictionary), SHARDS)
    written.write.mode("overwrite").parquet(f"{folder}/shards")
    return spark.read.schema(SHARDS).parquet(f"{folder}/shards")


def _decompressor(dictionary: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def _opened(folder: str, name: str) -> tuple[fs.FileSystem, str, bytes, np.ndarray]:
    store, root = _filesystem(folder)
    with store.open_input_stream(f"{root}/dictionary") as file:
        dictionary = file.read()
    with store.open_input_stream(f"{root}/{name}.idx") as file:
        data = file.read()
    if data[:HASH_BYTES] != _dictionary_hash(dictionary):
        raise ValueError(f"{name} was written with another dictionary")
    return store, f"{root}/{name}.bin", dictionary, np.frombuffer(data[HASH_BYTES:], "<i8").reshape(-1, INDEX)


def read_document(folder: str, shard: int, number: int, kind: str) -> np.ndarray:
    """The ids of one document of a shard, reading its bytes only."""
    store, root = _filesystem(folder)
    own = parquet.read_table(f"{root}/shards", columns=["name"], filesystem=store, filters=[("shard", "=", shard)])
    (name,) = own["name"].to_pylist()
    store, path, dictionary, index = _opened(folder, name)
    _, _, place, length, _ = index[number].tolist()
    with store.open_input_file(path) as file:
        file.seek(place)
        return np.frombuffer(_decompressor(dictionary).decompress(file.read(length)), kind)


def _read(folder: str, kind: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, path, dictionary, index = _opened(folder, name)
                decompressor = _decompressor(dictionary)
                with store.open_input_stream(path) as file:
                    for block in range(0, len(index), 1000):
                        rows = []
                        for has_id, doc, _, length, count in index[block : block + 1000].tolist():
                            ids = np.frombuffer(decompressor.decompress(file.read(length)), kind).astype("<u4")
                            if len(ids) != count:
                                raise ValueError(f"{name} is damaged")
                            rows.append((doc if has_id else None, start, count, crc32(ids.tobytes())))
                            start += count
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(column, pa.int64()) for column in zip(*rows)],
                            ["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    return read


def read_token_files(spark: SparkSession, folder: str, settings: Settings = Settings()) -> DataFrame:
    """Per document of the files: its id, the ids before it, its number of ids, their checksum."""
    shards = spark.read.schema(SHARDS).parquet(f"{folder}/shards").where("documents > 0")
    count = shards.count()
    placed = running_totals(shards, ["shard"], "tokens", "end", rows=count)
    # Dealt out one by one: a shard is as much work as the next.
    dealt = placed.select("name", (F.col("end") - F.col("tokens")).alias("start")).repartition(max(1, count))
    return map_arrow(
        dealt,
        _read(folder, id_type(tokenizer_path(settings.tokenizer))),
        "doc_id long, start long, n_tokens long, ids_crc32 long",
    )


def token_round_trip(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Write the token files of ``docs`` to the shared scratch folder and read them back."""
    folder = scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, folder, settings)
    return read_token_files(docs.sparkSession, folder, settings)
