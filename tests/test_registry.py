"""Every registered query against its SQL, at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from salesloom import registry

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_equals_sql(spark, con, name):
    assert name in entry.oracle_sql()
    result = compare(spark, con, FOLDER, name)
    assert result.startswith("ok"), result


def test_entry(spark):
    assert entry.entry(spark).count() == 83


def test_anchors(spark):
    from salesloom.registry import context
    from pyspark.sql import functions as F

    folder = "/root/testdata/sf0.01"
    lines = context.staged(spark, folder)
    sums = lines.agg(F.count("*"), *[F.sum(c) for c in ("gross_sales", "discounts", "net_sales", "cogs")]).first()
    assert [str(v) for v in sums] == [
        "60000", "3183256271.63", "159247548.54", "3024008723.09", "1447849638.00",
    ]
    products = context.star(spark, folder).dims["dim_product"]
    empty = products.where("end_date < effective_date").count()
    assert (products.count(), products.where("is_current").count(), empty) == (1984, 64, 168)


def test_entry_works_without_a_library_of_the_optional_queries():
    """A module that cannot be imported costs the training-data queries, not the others."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys; sys.modules['xxhash'] = None; sys.modules['zstandard'] = None\n"
        "import __spark_entry__ as e\n"
        "print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') for n in e.queries()))"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    counts = done.stdout.split()
    assert counts == [str(len(registry.QUERIES)), str(len(registry.ORACLES)), "False"], done.stderr
