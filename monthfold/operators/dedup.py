"""Deterministic duplicate removal."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthfold.operators.reshape import unpivot_months

# Cells per bit column: the non-negative bits of a long.
BITS = 63


def _group_columns(df: DataFrame, keys: Sequence[str], scope: str) -> list[str]:
    if scope not in ("file", "global"):
        raise ValueError("scope is 'file' or 'global'")
    columns = list(dict.fromkeys(keys))
    if scope == "file" and "source_file" not in columns:
        columns.append("source_file")
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"dedup keys not in the frame: {missing}")
    return columns


def dedup(
    df: DataFrame,
    keys: Sequence[str],
    scope: str = "file",
    amount: str = "sales_amount",
    determined: Sequence[str] = (),
    copies: str | None = None,
) -> DataFrame:
    """Keep one row per key: the one with the largest amount, null amounts last.

    Written as a ``max`` aggregate, not a window: every task folds its copies
    before the shuffle, so a key that holds a large share of all rows sends one
    row per task. ``determined`` names columns that the key fixes (month number,
    run timestamp); grouping by them changes nothing and keeps the plan a hash
    aggregate. Other columns are taken from the winning row as a whole, with ties
    on the amount settled by their values. ``copies`` adds the size of each group.
    """
    group = _group_columns(df, keys, scope)
    group += [c for c in determined if c in df.columns and c not in group]
    carried = [c for c in df.columns if c not in group and c != amount]
    size = [F.count(F.lit(1)).alias(copies)] if copies else []
    names = [f"`{c}`" for c in group]
    order = [f"`{c}`" for c in df.columns] + ([copies] if copies else [])
    if not carried:
        best = df.groupBy(*names).agg(F.max(f"`{amount}`").alias(amount), *size)
        return best.select(*order)
    row = F.struct(F.col(f"`{amount}`"), *[F.col(f"`{c}`") for c in carried])
    best = df.groupBy(*names).agg(F.max(row).alias("__best"), *size)
    kept = {c: F.col("__best").getField(c) for c in (amount, *carried)}
    return best.withColumns(kept).select(*order)


def dedup_wide(
    df: DataFrame,
    keys: Sequence[str],
    cells: Mapping[str, tuple[Column, Column]],
    determined: Sequence[str] = (),
    value: str = "sales_amount",
    spread: Sequence[str] = (),
) -> DataFrame:
    """Long rows with one row per key and month, folded before they are unpivoted.

    ``cells`` gives per month label the amount and whether the cell takes part. The
    result equals unpivoting, keeping the cells that take part, and :func:`dedup`
    within the keys; but the shuffle moves one row per wide row instead of one per
    cell. Which cells took part is kept as bits, because a cell may take part with
    a NULL amount. ``spread`` names columns by which the folded rows are dealt anew
    before they are unpivoted, for a write that is partitioned by them, and sorted within tasks.
    """
    group = list(dict.fromkeys([*keys, *[c for c in determined if c in df.columns]]))
    labels = list(cells)
    clash = set(labels) & set(group)
    if clash:
        raise ValueError(f"month labels collide with keys: {sorted(clash)}")
    taken = {label: f"__taken_{label}" for label in labels}
    blocks = [labels[start : start + BITS] for start in range(0, len(labels), BITS)]
    names = [F.col(f"`{c}`") for c in group]
    marked = df.select(
        *names,
        *[amount.alias(label) for label, (amount, _) in cells.items()],
        *[part.alias(taken[label]) for label, (_, part) in cells.items()],
    ).select(
        *names,
        *[F.when(F.col(taken[label]), F.col(label)).alias(label) for label in labels],
        *[
            reduce(
                lambda bits, more: bits.bitwiseOR(more),
                [F.shiftleft(F.col(taken[label]).cast("long"), bit) for bit, label in enumerate(block)],
            ).alias(f"__bits_{number}")
            for number, block in enumerate(blocks)
        ],
    )
    folded = marked.groupBy(*names).agg(
        *[F.max(label).alias(label) for label in labels],
        *[F.bit_or(f"__bits_{number}").alias(f"__bits_{number}") for number in range(len(blocks))],
    )
    if spread:
        # Neighbouring rows with equal texts take far less room in files and in later shuffles of their rows.
        folded = folded.hint("rebalance", *spread).sortWithinPartitions(*names)
    packed = folded.select(
        *names,
        *[
            F.struct(
                F.col(label).alias("amount"),
                (F.getbit(F.col(f"__bits_{number}"), F.lit(bit)) == 1).alias("taken"),
            ).alias(label)
            for number, block in enumerate(blocks)
            for bit, label in enumerate(block)
        ],
    )
    long = unpivot_months(packed, group, labels, value="cell")
    return long.where("cell.taken").select(*names, "month", F.col("cell.amount").alias(value))


def removed_count(df: DataFrame, keys: Sequence[str], scope: str = "file") -> DataFrame:
    """One row (before, after, removed) from a single pass over the frame."""
    group = [f"`{c}`" for c in _group_columns(df, keys, scope)]
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("copies"))
    return sizes.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("records_before"),
        F.count(F.lit(1)).alias("records_after"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("records_removed"),
    )
