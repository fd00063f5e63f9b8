"""Text to value conversions, composite labels and hashed keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands for a missing field inside a hashed key.
MISSING_FIELD = "_dbt_utils_surrogate_key_null_"


def parse_amount(text: Column, data_type: str = "decimal(18,2)") -> Column:
    """Number in currency text such as ``" $1,618.50 "``; NULL where there is none."""
    bare = F.replace(F.replace(text, F.lit(","), F.lit("")), F.lit("$"), F.lit(""))
    return F.trim(bare).try_cast(data_type)


# How days are written in the files.
DAY_FORMATS = ("yyyy-MM-dd", "M/d/yyyy", "yyyy-MM-dd HH:mm:ss", "yyyy/MM/dd", "dd-MMM-yyyy")


def parse_day(text: Column, formats: Sequence[str] = DAY_FORMATS) -> Column:
    """Date in ``text`` by the first format that fits; NULL where none does.

    A format is tried only on text that has its separators: a text that does not
    fit costs an exception, many times the reading of one that does.
    """
    bare = F.trim(text)

    def separated(day_format: str) -> Column:
        # What stands in optional brackets need not be there.
        marks = dict.fromkeys(c for c in day_format if c in "-/:" and "[" not in day_format)
        return reduce(lambda a, b: a & b, [F.contains(bare, F.lit(c)) for c in marks], F.lit(True))

    return F.coalesce(*[F.when(separated(f), F.try_to_timestamp(bare, F.lit(f))).cast("date") for f in formats])


def hashed_key(columns: Sequence[str | Column]) -> Column:
    """md5 over the fields' text joined by ``-``, with a marker for missing fields."""
    fields = [F.col(c) if isinstance(c, str) else c for c in columns]
    texts = [F.coalesce(f.cast("string"), F.lit(MISSING_FIELD)) for f in fields]
    return F.md5(F.concat_ws("-", *texts))


def quarter_label(year: Column, quarter: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-Q"), quarter.cast("string"))


def month_label(year: Column, month: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))
