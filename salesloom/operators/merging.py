"""Merging into a snapshot table file by file, with additive side tables kept as signed deltas.

The fact is stored by sale year and, if wanted, by buckets of the id's hash
below it.  A merge looks for the changed ids only in the folders their years and
buckets name, reading one column, and rewrites the files that hold one of them.
All rows of an id share year and bucket, as the id hashes the sale date.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.operators.facts import YEAR_COLUMN, deduplicate, repeated_ids, with_year
from salesloom.operators.incremental import stored_types, sync_columns
from salesloom.operators.ordering import BROADCAST_ROWS
from salesloom.session import release, scratch_path, table_writer
from salesloom.sources import snapshots, storage
from salesloom.sources.snapshots import DATA, Snapshot

BUCKET_COLUMN = "id_bucket"
# Deltas of a side table are added up once there are this many.
MOST_DELTAS = 8
_SIDES = "_sides"


@dataclass(frozen=True)
class Side:
    """A table kept beside the fact, that changes by what the rows of changed ids add and take away.

    ``of`` gives its rows for rows of the fact, of which it gets all copies of
    an id or none, and whether these are the whole fact; ``sums`` are its
    additive columns.
    """

    name: str
    of: Callable[[DataFrame, bool], DataFrame]
    sums: tuple[str, ...]

    def change(self, rows: DataFrame) -> DataFrame:
        """What rows with a ``_sign`` of 1 add and those of -1 take away."""

        def signed(sign: int) -> DataFrame:
            found = self.of(rows.where(F.col("_sign") == sign).drop("_sign"), False)
            return found.withColumns({c: (F.col(c) * sign).cast(found.schema[c].dataType) for c in self.sums})

        return signed(1).unionByName(signed(-1))


def _surplus(fact: DataFrame, whole: bool) -> DataFrame:
    """Surplus rows; ``mixed`` counts ids whose copies differ in a key."""
    return repeated_ids(fact, whole).withColumn("mixed", F.col("mixed").cast("long"))


SURPLUS = Side("surplus", _surplus, ("surplus", "mixed"))


def with_layout(fact: DataFrame, buckets: int, key: str = "transaction_id") -> DataFrame:
    """The fact with its partition columns."""
    dated = fact if YEAR_COLUMN in fact.columns else with_year(fact)
    return dated.withColumn(BUCKET_COLUMN, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")) if buckets else dated


def layout_columns(buckets: int) -> list[str]:
    return [YEAR_COLUMN, BUCKET_COLUMN] if buckets else [YEAR_COLUMN]


def _store_delta(spark: SparkSession, path: str, side: Side, delta: DataFrame, earlier: Sequence[str]) -> list[str]:
    """Write signed rows of a side table; returns the names of all deltas that count."""
    names, folder = list(earlier), f"{path}/{_SIDES}/{side.name}"
    if len(names) + 1 >= MOST_DELTAS:
        old = spark.read.schema(delta.schema).parquet(*[f"{folder}/{name}" for name in names])
        keys = [c for c in delta.columns if c not in side.sums]
        totals = [F.sum(c).cast(delta.schema[c].dataType).alias(c) for c in side.sums]
        left = reduce(lambda a, b: a | b, [F.col(c) != 0 for c in side.sums])
        delta = old.unionByName(delta).groupBy(*keys).agg(*totals).where(left)
        names = []
    part = scratch_path(spark, "delta").rsplit("/", 1)[1]
    table_writer(delta).parquet(f"{folder}/{part}")
    return [*names, part]


def _side_by_side(tasks: dict[str, Callable]) -> dict:
    """Run independent writes as concurrent jobs."""
    if not tasks:
        return {}
    with ThreadPoolExecutor(len(tasks)) as pool:
        return dict(zip(tasks, pool.map(lambda task: task(), tasks.values())))


def _clear_deltas(spark: SparkSession, path: str) -> None:
    """Remove deltas that no version left names."""
    stamps = [snapshots.opened(spark, path, version).stamps for version in snapshots.versions(spark, path)]
    for side in storage.names_in(spark, f"{path}/{_SIDES}"):
        live = {name for stamp in stamps for name in stamp.get("sides", {}).get("parts", {}).get(side, [])}
        for name in set(storage.names_in(spark, f"{path}/{_SIDES}/{side}")) - live:
            storage.delete(spark, f"{path}/{_SIDES}/{side}/{name}")


def publish_fact(
    fact: DataFrame,
    path: str,
    buckets: int = 0,
    grouped: bool = False,
    stamps: dict | None = None,
    sides: Sequence[Side] = (SURPLUS,),
) -> Snapshot:
    """Make ``fact`` the whole content of the fact table, with its side tables.

    ``grouped`` skips the shuffle by partition for rows that come from a table
    already stored by year.
    """
    spark = fact.sparkSession
    laid = with_layout(fact, buckets)
    spread = laid if grouped and not buckets else laid.hint("rebalance", *layout_columns(buckets))
    current = snapshots.opened(spark, path)
    part = snapshots.write_parts(spread, path, layout_columns(buckets))
    release(spark)
    schema = laid.drop(BUCKET_COLUMN).schema
    version = current.version + 1 if current else 1
    stored = Snapshot(path, version, schema, (part,)).read(spark)
    parts = _side_by_side({side.name: partial(_store_delta, spark, path, side, side.of(stored, True), []) for side in sides})
    done = snapshots.commit(
        spark,
        path,
        schema,
        [part],
        {**(stamps or {}), "buckets": buckets, "sides": {"version": version, "parts": parts}},
        after=version - 1,
    )
    _clear_deltas(spark, path)
    release(spark)
    return done


def side_rows(spark: SparkSession, fact: Snapshot, name: str) -> DataFrame | None:
    """The signed rows of a side table for exactly this version of the fact.

    None if they were stamped for another version, as after a write that did
    not keep them up.
    """
    stamp = fact.stamps.get("sides", {})
    if stamp.get("version") != fact.version or name not in stamp["parts"]:
        return None
    return spark.read.parquet(*[f"{fact.path}/{_SIDES}/{name}/{part}" for part in stamp["parts"][name]])


def surplus_of(spark: SparkSession, fact: Snapshot) -> DataFrame | None:
    """Surplus rows of this version of the fact, or None if distinct ids have to be counted.

    That is so without surplus rows for this version, and if copies of an id
    disagree in a key.
    """
    rows = side_rows(spark, fact, SURPLUS.name)
    if rows is None:
        return None
    mixed = rows.agg(F.coalesce(F.sum("mixed"), F.lit(0))).first()[0]
    if mixed != 0:
        return None
    if len(fact.stamps["sides"]["parts"][SURPLUS.name]) == 1:
        return rows.drop("mixed")
    # What one delta adds and another takes away belongs to no group any more.
    keys = [c for c in rows.columns if c not in SURPLUS.sums]
    return rows.groupBy(*keys).agg(F.sum("surplus").alias("surplus")).where("surplus <> 0")


def _folder_of(names: Sequence[str], values: Sequence) -> str:
    return "/".join(f"{n}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for n, v in zip(names, values))


def _holding(table: Snapshot, spark: SparkSession, files: Sequence[str], wanted: DataFrame, key: str) -> list[str]:
    """Those of ``files`` with a row whose key is wanted; one column of them is read."""
    if not files:
        return []
    # Sources with hidden file metadata need it picked before anything else is.
    base = f"{table.path}/{DATA}"
    rows = spark.read.schema(table.schema).option("basePath", base).parquet(*[f"{base}/{file}" for file in files])
    probed = rows.select(key, F.col("_metadata.file_path").alias("_file"))
    names = [r[0] for r in probed.join(wanted, key, "left_semi").select("_file").distinct().collect()]
    return sorted("commit=" + unquote(name).rsplit("/commit=", 1)[1] for name in names)


def _large(spark: SparkSession, root: str, files: Sequence[str]) -> list[str]:
    """Those of ``files`` with at least a quarter of the bytes of the largest one in their folder."""
    sizes = {file: storage.content_length(spark, f"{root}/{file}") for file in files}
    most: dict[str, int] = {}
    for file, size in sizes.items():
        place = file.split("/", 1)[1].rsplit("/", 1)[0]
        most[place] = max(most.get(place, 0), size)
    return [file for file in files if sizes[file] * 4 >= most[file.split("/", 1)[1].rsplit("/", 1)[0]]]


def merge_fact(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    policy: str = "error",
    removed_loads: Sequence[str] = (),
    stamps: dict | None = None,
    sides: Sequence[Side] = (SURPLUS,),
    key: str = "transaction_id",
) -> Snapshot:
    """The next version of the fact at ``path``: ``updates`` merged in by ``key``.

    Rows of the loads at the times ``removed_loads`` go.  Under the policies
    ``error`` and ``latest`` updates replace rows with their id; under
    ``keep_all`` they are added.  ``error`` raises if the updates repeat an id.
    Only files that hold a changed id are rewritten, once each; side tables get
    a delta for just these ids.  Those not named in ``sides`` are not kept up
    and fall away.  Nothing is seen of the merge before it is complete, and a
    repeated one gives the same rows.
    """
    table = snapshots.opened(spark, path)
    buckets = table.stamps.get("buckets", 0)
    layout = layout_columns(buckets)
    stage = scratch_path(spark, "merge")
    typed = stored_types(with_layout(updates, buckets, key), table.read(spark, []))
    table_writer(typed).parquet(f"{stage}/updates")
    release(spark)
    updates = spark.read.parquet(f"{stage}/updates")
    new = deduplicate(updates, policy)
    gone: Column = F.lit(False)
    # Every policy keeps all ids, so they are read off the updates: the rows of ``new`` are made once, to be written.
    named = updates if key == "transaction_id" else new
    changed = named.select(key, *layout)
    if removed_loads:
        gone = F.col("load_date").isin([F.lit(time).cast("timestamp") for time in removed_loads])
        gone = F.coalesce(gone, F.lit(False))
        # Only a file that was loaded again comes here; the scan reads ids, days and load times.
        left = with_layout(table.read(spark).where(gone), buckets, key)
        changed = changed.unionByName(left.select(key, *layout))
    table_writer(changed.distinct()).parquet(f"{stage}/changed")
    changed = spark.read.schema(changed.schema).parquet(f"{stage}/changed")

    # One small row per year and bucket that changes.
    places = {_folder_of(layout, tuple(row)) for row in changed.select(*layout).distinct().collect()}
    files = table.files(spark)
    version, held = table.version + 1, table.stamps.get("sides", {})
    keeps_up = held.get("version") == table.version
    known = [side for side in sides if keeps_up and side.name in held["parts"]]
    if not places:
        kept_sides = {**held, "version": version} if keeps_up else held
        return snapshots.commit(
            spark, path, table.schema, table.parts, {**table.stamps, **(stamps or {}), "sides": kept_sides, "rewritten": 0},
            after=table.version,
        )
    near = [file for file in files if file.split("/", 1)[1].rsplit("/", 1)[0] in places]
    ids = changed.select(key)
    touched = _holding(table, spark, near, ids, key)
    nameless = changed.where(F.col(key).isNull()).limit(1).count() > 0
    if nameless and removed_loads:
        # Rows without an id are found by their load alone.
        touched = near
    schema = new.drop(BUCKET_COLUMN).schema
    old = sync_columns(table.read(spark, touched), schema)
    few = policy == "keep_all" or ids.count() <= BROADCAST_ROWS

    def remaining(files: Sequence[str]) -> DataFrame:
        """The rows of these files that stay."""
        rows = sync_columns(table.read(spark, files), schema)
        rows = rows.where(~gone) if removed_loads else rows
        if policy != "keep_all":
            replaced = named.select(key).distinct()
            rows = rows.join(F.broadcast(replaced) if few else replaced, key, "left_anti").select(*schema.names)
        return with_layout(rows, buckets, key)

    # Rows of large files stay in their folders where a broadcast finds those that go: they are not shuffled.
    # What earlier merges have added in small files is put together with the new rows.
    large = _large(spark, f"{path}/{DATA}", touched) if few else []
    small = [file for file in touched if file not in set(large)]
    folders = [snapshots.write_parts(remaining(small).unionByName(new).hint("rebalance", *layout), path, layout)]
    release(spark)
    if large:
        folders.append(snapshots.write_parts(remaining(large), path, layout))
    left_files = [file for file in files if file not in set(touched)]
    written = [file for folder in folders for file in storage.data_files(spark, f"{path}/{DATA}", folder)]
    release(spark)

    fresh = Snapshot(path, version, schema, tuple(written)).read(spark)

    def of_changed(rows: DataFrame) -> DataFrame:
        return rows.join(ids, key, "left_semi").unionByName(rows.where(F.col(key).isNull()))

    parts = {}
    if known:
        rows = of_changed(fresh).withColumn("_sign", F.lit(1)).unionByName(of_changed(old).withColumn("_sign", F.lit(-1)))
        table_writer(rows).parquet(f"{stage}/signed")
        rows = spark.read.schema(rows.schema).parquet(f"{stage}/signed")
        parts = _side_by_side(
            {
                side.name: partial(_store_delta, spark, path, side, side.change(rows), held["parts"][side.name])
                for side in known
            }
        )
    now = {"version": version, "parts": parts} if keeps_up else held
    done = snapshots.commit(
        spark,
        path,
        schema,
        [*left_files, *written],
        {**table.stamps, **(stamps or {}), "sides": now, "rewritten": len(touched)},
        after=table.version,
    )
    _clear_deltas(spark, path)
    storage.delete(spark, stage)
    release(spark)
    return done
