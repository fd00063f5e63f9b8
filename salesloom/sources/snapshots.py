"""Stored tables as numbered versions.

Below the table's folder lie ``data/commit=…`` with the files of each write and
``_versions/<number>.json``, a small pointer per version: schema, the files or
folders that make up the table, and stamps of whoever wrote it.  A version
exists once its pointer does; pointers are never rewritten.  A write that fails
before leaves the table as it was, and a frame read from a version goes on
reading the files of that version while newer ones appear.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from salesloom.session import table_writer
from salesloom.sources import storage

POINTERS, DATA = "_versions", "data"
# Versions that stay readable after a write, the new one included.
KEEP = 2


@dataclass(frozen=True)
class Snapshot:
    """One version of the table at ``path``; ``parts`` are files or folders below its data folder."""

    path: str
    version: int
    schema: T.StructType
    parts: tuple[str, ...]
    stamps: dict = field(default_factory=dict)

    def read(self, spark: SparkSession, parts: Sequence[str] | None = None, with_layout: bool = False) -> DataFrame:
        """The rows, or those of some ``parts``; ``with_layout`` adds columns that are only in folder names."""
        chosen = self.parts if parts is None else tuple(parts)
        if not chosen:
            return spark.createDataFrame([], self.schema)
        base = f"{self.path}/{DATA}"
        rows = spark.read.schema(self.schema).option("basePath", base).parquet(*[f"{base}/{part}" for part in chosen])
        extra = [c for c in rows.columns if c not in self.schema.names and c != "commit"] if with_layout else []
        return rows.select(*[f"`{c}`" for c in self.schema.names], *extra)

    def files(self, spark: SparkSession) -> list[str]:
        """The files of this version, folders resolved; as many as Spark lists to read the table."""
        found = []
        for part in self.parts:
            found += [part] if part.endswith(".parquet") else storage.data_files(spark, f"{self.path}/{DATA}", part)
        return found


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that can be read, oldest first."""
    names = storage.names_in(spark, f"{path}/{POINTERS}")
    return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())


def is_snapshot(spark: SparkSession, path: str) -> bool:
    return bool(versions(spark, path))


def opened(spark: SparkSession, path: str, version: int | None = None) -> Snapshot | None:
    """The newest version, or the one asked for; None if the table does not exist."""
    known = versions(spark, path)
    if not known or (version is not None and version not in known):
        return None
    number = known[-1] if version is None else version
    entry = json.loads(storage.read_text(spark, f"{path}/{POINTERS}/{number:010d}.json"))
    schema = T.StructType.fromJson(entry["schema"])
    return Snapshot(path, number, schema, tuple(entry["parts"]), entry["stamps"])


def write_parts(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Write the files of a coming version; nobody reads them before ``commit``."""
    part = f"commit=c{uuid.uuid4().hex[:16]}"
    table_writer(df, partition_by).parquet(f"{path}/{DATA}/{part}")
    return part


def commit(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    parts: Sequence[str],
    stamps: dict | None = None,
    after: int | None = None,
    keep: int = KEEP,
) -> Snapshot:
    """Make ``parts`` the next version and clear versions beyond ``keep``.

    ``after`` is the version the parts were derived from (0 if there was none);
    if another writer has added one since, the commit fails.
    """
    known = versions(spark, path)
    last = known[-1] if known else 0
    if after is not None and after != last:
        raise FileExistsError(f"{path} is at version {last}, the write was made from {after}")
    entry = {"schema": json.loads(schema.json()), "parts": list(parts), "stamps": stamps or {}}
    storage.write_text_once(spark, f"{path}/{POINTERS}/{last + 1:010d}.json", json.dumps(entry))
    clear(spark, path, keep)
    return Snapshot(path, last + 1, schema, tuple(parts), stamps or {})


def publish(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), stamps: dict | None = None, keep: int = KEEP
) -> DataFrame:
    """Make ``df`` the whole content of the table at ``path`` and return it as stored.  ``df`` may read that table."""
    spark = df.sparkSession
    part = write_parts(df, path, partition_by)
    return commit(spark, path, df.schema, [part], stamps, keep=keep).read(spark)


def append(df: DataFrame, path: str, stamps: dict | None = None, keep: int = KEEP) -> Snapshot:
    """Add the rows of ``df`` to the table at ``path``, which it may start; stamps are added to those of the last version."""
    spark = df.sparkSession
    current = opened(spark, path)
    part = write_parts(df, path)
    return commit(
        spark,
        path,
        df.schema,
        [*(current.parts if current else ()), part],
        {**(current.stamps if current else {}), **(stamps or {})},
        after=current.version if current else 0,
        keep=keep,
    )


def clear(spark: SparkSession, path: str, keep: int = KEEP) -> None:
    """Remove all versions but the last ``keep``, and the files only they name."""
    known = versions(spark, path)
    old, kept = known[:-keep], known[-keep:]
    if not old:
        return
    needed = {file for version in kept for file in opened(spark, path, version).parts}
    held = [part for part in needed if not part.endswith(".parquet")]
    for version in old:
        for part in opened(spark, path, version).parts:
            if part in needed or part.startswith(tuple(f"{folder}/" for folder in held)):
                continue
            if any(other.startswith(f"{part}/") for other in needed):
                # A folder some files of which are still needed goes file by file.
                for file in storage.data_files(spark, f"{path}/{DATA}", part):
                    if file not in needed:
                        storage.delete(spark, f"{path}/{DATA}/{file}")
            else:
                storage.delete(spark, f"{path}/{DATA}/{part}")
        storage.delete(spark, f"{path}/{POINTERS}/{version:010d}.json")


def clear_unfinished(spark: SparkSession, path: str) -> list[str]:
    """Remove writes that no version names, left by runs that failed; only while nobody writes the table."""
    named = {part.split("/", 1)[0] for version in versions(spark, path) for part in opened(spark, path, version).parts}
    left = [name for name in storage.names_in(spark, f"{path}/{DATA}") if name.startswith("commit=") and name not in named]
    for name in left:
        storage.delete(spark, f"{path}/{DATA}/{name}")
    return left
