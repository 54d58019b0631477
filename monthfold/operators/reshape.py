"""Wide-to-long reshaping and by-name union."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthfold.functions.amounts import to_amount
from monthfold.functions.months import MONTHS, month_label, month_number, quarter_of
from monthfold.schema import CURATED, SALES_COLUMN_PATTERN


class NoMeasureColumns(ValueError):
    """There is nothing to unpivot."""


def cast_measures(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Bring all measure columns to decimal(18,2); cells that are not numbers become NULL."""
    return df.withColumns({name: to_amount(F.col(f"`{name}`")) for name in measures})


def _selected(measures: Sequence[str], months: Sequence[str] | None, pattern: str) -> dict[str, str]:
    if not measures:
        raise NoMeasureColumns("no column matches the measure pattern")
    labels = {name: month_label(name, pattern) for name in measures}
    if months is not None:
        labels = {name: label for name, label in labels.items() if label in months}
    return labels


def unpivot_months(
    df: DataFrame,
    ids: Sequence[str],
    measures: Sequence[str],
    drop_nulls: bool = False,
    months: Sequence[str] | None = None,
    value: str = "sales_amount",
    pattern: str = SALES_COLUMN_PATTERN,
) -> DataFrame:
    """One row per (input row, measure) with columns ``ids, month, value``.

    A single narrow pass over the input: no shuffle, rows times the number of
    measures. Null cells are kept unless ``drop_nulls``. ``months`` restricts the
    columns that are read at all, because a filter on the produced ``month`` would
    not reach below the unpivot. Measures of different types meet as text, which
    loses nothing; a single type is passed through.
    """
    labels = _selected(measures, months, pattern)
    clash = set(labels.values()) & set(ids)
    if clash:
        raise ValueError(f"month labels collide with identifiers: {sorted(clash)}")
    if not labels:
        first = F.col(f"`{measures[0]}`")
        return df.select(*[f"`{c}`" for c in ids], F.lit("").alias("month"), first.alias(value)).where(F.lit(False))
    types = {df.schema[name].dataType.simpleString() for name in labels}
    cells = [
        (F.col(f"`{name}`") if len(types) == 1 else F.col(f"`{name}`").cast("string")).alias(label)
        for name, label in labels.items()
    ]
    renamed = df.select(*[F.col(f"`{c}`") for c in ids], *cells)
    long = renamed.unpivot(
        [F.col(f"`{c}`") for c in ids], [F.col(f"`{c}`") for c in labels.values()], "month", value
    )
    return long.where(F.col(value).isNotNull()) if drop_nulls else long


def unpivot_months_union(
    df: DataFrame, ids: Sequence[str], measures: Sequence[str], pattern: str = SALES_COLUMN_PATTERN
) -> DataFrame:
    """The same rows as ``unpivot_months(drop_nulls=True)`` from one branch per month.

    Reads the input once per month. It is the check of the single-scan form, which
    every other code path uses.
    """
    branches = []
    for name, label in _selected(measures, None, pattern).items():
        number = MONTHS.index(label) + 1 if label in MONTHS else None
        quarter = (number + 2) // 3 if number else None
        branches.append(
            df.where(F.col(f"`{name}`").isNotNull()).select(
                *[F.col(f"`{c}`") for c in ids],
                F.lit(label).alias("month"),
                F.lit(number).cast("int").alias("month_number"),
                F.col(f"`{name}`").alias("sales_amount"),
                F.lit(quarter).cast("int").alias("quarter"),
            )
        )
    return reduce(DataFrame.unionAll, branches)


def add_month_number(df: DataFrame, unknown: str = "zero") -> DataFrame:
    """Add ``month_number`` from ``month``; ``unknown`` says what other labels give."""
    return df.withColumn("month_number", month_number(F.col("month"), unknown))


def add_quarter(df: DataFrame) -> DataFrame:
    """Add ``quarter`` from ``month_number``."""
    return df.withColumn("quarter", quarter_of(F.col("month_number")))


def to_output(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The curated columns in their declared order and type, then ``extra`` ones.

    Curated columns the input does not have come out as NULL.
    """
    present = set(df.columns)
    columns = [
        (F.col(f"`{field.name}`") if field.name in present else F.lit(None))
        .cast(field.dataType)
        .alias(field.name)
        for field in CURATED
    ]
    return df.select(*columns, *[F.col(f"`{c}`") for c in extra])


def union_shapes(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column absent from one frame is NULL in its rows."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
