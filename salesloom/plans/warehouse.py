"""The star schema as stored tables, and the ordered run that builds it."""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.functions.measures import TOTALS
from salesloom.operators import dimensions as dm
from salesloom.operators import facts, incremental
from salesloom.operators.evolving import extended_dimensions
from salesloom.operators.merging import SURPLUS, Side, merge_fact, publish_fact, side_rows, surplus_of
from salesloom.operators.staging import stage
from salesloom.plans.cubes import CUBES
from salesloom.plans.cubes import SIDES as CUBE_SIDES
from salesloom.schemas import STAGING, conform
from salesloom.session import release, scratch_path, table_writer
from salesloom.sources import storage
from salesloom.sources.loads import land_file, landed, ledger
from salesloom.sources.snapshots import Snapshot, opened, publish
from salesloom.sources.tables import read_table

FACT_TABLE = "fact_financial_transactions"
DIMENSIONS = ("dim_date", "dim_product", "dim_segment", "dim_geography", "dim_discount")


@dataclass(frozen=True)
class Star:
    """A fact with its dimensions.

    ``repeats`` (see ``repeated_ids``) lets reports count distinct transactions
    additively; without it they fall back to an exact distinct count.
    ``cubes`` are totals kept beside the fact (see ``plans.cubes``), used where
    they suffice.  ``rows`` holds the sizes of the dimensions and of the fact,
    ``small`` the measures known to be small; both are filled on first use.
    """

    fact: DataFrame
    dims: dict[str, DataFrame]
    repeats: DataFrame | None = None
    rows: dict[str, int] = field(default_factory=dict)
    small: dict[str, bool] = field(default_factory=dict)
    cubes: dict[str, DataFrame] = field(default_factory=dict)

    def lines(self) -> int:
        """Rows of the fact, from the file footers."""
        if FACT_TABLE not in self.rows:
            self.rows[FACT_TABLE] = self.fact.count()
        return self.rows[FACT_TABLE]

    def size(self, dim: str) -> int:
        if dim not in self.rows:
            self.rows[dim] = self.dims[dim].count()
        return self.rows[dim]

    def is_small(self, measure: str) -> bool:
        """Whether every value of ``measure`` fits decimal(8,2); one narrow scan for all measures."""
        if measure not in self.small:
            wanted = list(dict.fromkeys([*TOTALS.values(), measure]))
            fits = [F.coalesce(F.max(F.abs(m)) < 10**6, F.lit(True)).alias(m) for m in wanted]
            self.small.update(self.fact.agg(*fits).first().asDict())
        return self.small[measure]


@dataclass(frozen=True)
class Settings:
    """What varies between installations."""

    spine_start: str = "2010-01-01"
    spine_end: str = "2030-12-31"
    weekend_days: tuple[int, ...] = (5, 6)
    regions: DataFrame | None = None
    bands: DataFrame | None = None
    holidays: DataFrame | None = None
    policy: str = "error"
    staged_by_year: bool = False
    # Buckets of the id's hash below each year of the fact: a merge reads and rewrites within them.
    buckets: int = 0
    # Whether totals for the reports are kept beside the fact and merged with it.
    cubes: bool = True

    @property
    def sides(self) -> tuple[Side, ...]:
        return (SURPLUS, *CUBE_SIDES) if self.cubes else (SURPLUS,)


def side_by_side(tasks: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
    """Run independent table builds as concurrent jobs."""
    with ThreadPoolExecutor(len(tasks)) as pool:
        return dict(zip(tasks, pool.map(lambda build: build(), tasks.values())))


def build_dimensions(staged: DataFrame, path: str, settings: Settings, keep_keys: bool = False) -> dict[str, DataFrame]:
    """Write the five dimensions, as independent jobs side by side.

    ``keep_keys`` extends the dimensions stored at ``path`` by the members of
    ``staged`` instead of renumbering them, so stored fact rows keep pointing at
    the same members; ``staged`` need then hold new lines only.
    """
    spark = staged.sparkSession
    builders = {
        "dim_date": lambda: dm.dim_date(
            spark, settings.spine_start, settings.spine_end, settings.weekend_days, settings.holidays
        ),
        "dim_product": lambda: dm.dim_product(staged),
        "dim_segment": lambda: dm.dim_segment(staged),
        "dim_geography": lambda: dm.dim_geography(staged, settings.regions),
        "dim_discount": lambda: dm.dim_discount(staged, settings.bands),
    }
    if keep_keys:
        builders.update(extended_dimensions(load_dimensions(spark, path), staged, settings.regions, settings.bands))

    def build(name: str) -> DataFrame:
        return publish(builders[name](), f"{path}/{name}")

    return side_by_side({name: partial(build, name) for name in builders})


def star_of(spark: SparkSession, fact: Snapshot, dims: dict[str, DataFrame], rows: dict[str, int] | None = None) -> Star:
    """A star over one version of the fact; side tables are used only if they belong to that version."""
    surplus = surplus_of(spark, fact)
    cubes = {name: side_rows(spark, fact, f"cube_{name}") for name in CUBES}
    known = {name: cube for name, cube in cubes.items() if cube is not None}
    # Distinct transactions of a cube are its lines less the surplus, so without that it is of no use.
    return Star(fact.read(spark), dims, surplus, rows or {}, cubes=known if surplus is not None else {})


def build_star(staged: DataFrame, path: str, settings: Settings = Settings(), stamps: dict | None = None) -> Star:
    """Full build of dimensions and fact from the staging relation, which is read several times: best stored."""
    dims = build_dimensions(staged, path, settings)
    rows = {name: dim.count() for name, dim in dims.items()}
    release(staged.sparkSession)
    # Repeats are settled on the lines, before five lookups widen the plan.
    lines = facts.deduplicate(facts.identified(staged), settings.policy, loaded="load_datetime")
    fact = publish_fact(
        facts.sales_fact(lines, dims, rows),
        f"{path}/{FACT_TABLE}",
        settings.buckets,
        grouped=settings.staged_by_year,
        stamps=stamps,
        sides=settings.sides,
    )
    return star_of(staged.sparkSession, fact, dims, rows)


def load_dimensions(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    return {name: read_table(spark, f"{path}/{name}") for name in DIMENSIONS}


def load_star(spark: SparkSession, path: str) -> Star:
    """The stored star, each table at its newest version."""
    fact = opened(spark, f"{path}/{FACT_TABLE}")
    if fact is None:
        raise FileNotFoundError(f"no fact is stored below {path}")
    return star_of(spark, fact, load_dimensions(spark, path))


@dataclass
class RunSummary:
    """Outcome of one run: seconds per step, checks, verdict."""

    steps: dict[str, float] = field(default_factory=dict)
    checks: DataFrame | None = None
    passed: bool = True
    incremental_start: str | None = None


def run_warehouse(
    spark: SparkSession,
    root: str,
    raw_csv: str | None = None,
    full_refresh: bool = False,
    skip_load: bool = False,
    skip_checks: bool = False,
    start: str | None = None,
    settings: Settings = Settings(),
) -> RunSummary:
    """Load, stage, dimensions, fact, reports, checks: in order, below ``root``.

    A step that raises ends the run, and the run can be repeated: a file with
    the same content replaces its own load, every table changes by one new
    version, and the fact names the loads it holds.  ``full_refresh`` rebuilds
    everything from the loads that count.  Otherwise the loads that the fact
    does not hold yet are merged into it, and rows of loads that were replaced
    go; with ``start``, all loads of later days are merged (again).  Only these
    loads are read and parsed.
    """
    from salesloom.operators.quality import run_checks, verdict
    from salesloom.plans.reports import REPORTS

    summary = RunSummary()
    clock = time.monotonic()

    def done(step: str) -> None:
        nonlocal clock
        release(spark)
        summary.steps[step] = round(time.monotonic() - clock, 3)
        clock = time.monotonic()

    landed_path, star_path = f"{root}/raw_financials", f"{root}/staging"
    fact_path = f"{star_path}/{FACT_TABLE}"
    if not skip_load:
        if raw_csv is None:
            raise FileNotFoundError("no raw file is named")
        land_file(spark, landed_path, raw_csv)
        done("load")

    loads = ledger(spark, landed_path)
    live = [load.loaded_at for load in loads]
    stored = opened(spark, fact_path)
    rebuild = full_refresh or stored is None
    held = [] if rebuild else stored.stamps.get("loads", [])
    chosen = [load for load in loads if load.loaded_at not in held]
    if not rebuild:
        summary.incremental_start = start or incremental.day_of(max(held, default=None))
        if start is not None:
            chosen = [load for load in loads if load.loaded_at[:10] > start]
    # The text of the loads at hand is parsed once; what follows reads typed columns.
    parsed = scratch_path(spark, "staged")
    table_writer(stage(landed(spark, landed_path, chosen))).parquet(parsed)
    staged = conform(spark.read.schema(STAGING).parquet(parsed), STAGING)
    done("staging")
    if rebuild:
        star = build_star(staged, star_path, settings, {"loads": live})
        done("dimensions and fact")
    else:
        dims = build_dimensions(staged, star_path, settings, keep_keys=True)
        done("dimensions")
        rows = {name: dim.count() for name, dim in dims.items()}
        merged = {load.loaded_at for load in chosen} | set(held)
        fact = merge_fact(
            spark,
            fact_path,
            facts.sales_fact(staged, dims, rows),
            settings.policy,
            # Under keep_all the rows of a load that is merged again have to go first.
            removed_loads=[t for t in held if t not in live or (start and t[:10] > start)],
            stamps={"loads": [t for t in live if t in merged]},
            sides=settings.sides,
        )
        star = star_of(spark, fact, dims, rows)
        done("fact")

    def report(name: str) -> DataFrame:
        return publish(REPORTS[name](star), f"{root}/analytics/{name}")

    reports = side_by_side({name: partial(report, name) for name in REPORTS})
    done("reports")
    if not skip_checks:
        summary.checks = publish(run_checks(star, reports), f"{root}/checks")
        summary.passed = verdict(summary.checks).first()["passed"]
        done("checks")
    storage.delete(spark, parsed)
    return summary
