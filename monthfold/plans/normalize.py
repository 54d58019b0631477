"""From one wide frame to long, typed, validated rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthfold.functions.months import month_label
from monthfold.operators.dedup import dedup, dedup_wide
from monthfold.operators.reshape import add_month_number, add_quarter, to_output, unpivot_months
from monthfold.operators.validate import (
    PROFILES,
    Profile,
    cell_rules,
    flag,
    holds_key,
    month_broken,
    none_broken,
    row_rules,
    split,
)
from monthfold.schema import IDENTIFIER_COLUMNS, PROVENANCE, SALES_COLUMN_PATTERN, classify
from monthfold.sources.wide import BEYOND, typed_wide

# Columns that the dedup key or the run fixes.
DETERMINED = ("month_number", "quarter", "load_timestamp", "run_id")


def identifiers_and_measures(
    columns: Sequence[str],
    profile: Profile,
    pattern: str = SALES_COLUMN_PATTERN,
    identifiers: Sequence[str] = IDENTIFIER_COLUMNS,
) -> tuple[list[str], dict[str, str]]:
    """(identifiers, measures with their month labels) under a profile's classification.

    What a scan found beyond the header is neither: :func:`typed_wide` turns it into a reject.
    """
    declared = [name for name in columns if name != BEYOND]
    ids, measures = classify(declared, pattern, identifiers if profile.allow_list else None)
    return ids, {name: month_label(name, pattern) for name in measures}


def add_calendar(long: DataFrame, profile: Profile) -> DataFrame:
    """Add month number and quarter the way the profile treats unknown months."""
    return add_quarter(add_month_number(long, profile.unknown_month))


def flagged_cells(
    cells: DataFrame, profile: Profile, ids: Sequence[str], present: Mapping[str, Column] | None = None
) -> DataFrame:
    """Flag unpivoted cells of a typed frame; ``sales_raw`` is text that was no number."""
    flagged = flag(add_calendar(cells, profile), profile, ids, present)
    return flagged.withColumn("sales_raw", F.try_element_at("unparsed", F.col("month")))


def long_rows(
    wide: DataFrame,
    profile: Profile,
    pattern: str = SALES_COLUMN_PATTERN,
    identifiers: Sequence[str] = IDENTIFIER_COLUMNS,
    months: Sequence[str] | None = None,
) -> DataFrame:
    """Flagged long rows of a wide frame; one narrow pass without a shuffle."""
    ids, measures = identifiers_and_measures(wide.columns, profile, pattern, identifiers)
    provenance = [c for c in PROVENANCE if c in wide.columns]
    typed = typed_wide(wide, ids, measures)
    cells = unpivot_months(typed, [*ids, *provenance, "unparsed"], list(measures), months=months, pattern=pattern)
    return flagged_cells(cells, profile, ids)


def valid_cells(
    typed: DataFrame,
    ids: Sequence[str],
    measures: Mapping[str, str],
    profile: Profile,
    present: Mapping[str, Column] | None = None,
) -> dict[str, tuple[Column, Column]]:
    """Per month label, the amount and whether the profile accepts the cell.

    ``present`` tells whether the row's file has a column at all, for columns that
    not every file has.
    """
    row = none_broken(row_rules(typed.columns, profile, ids, present))
    cells = {}
    for name, label in measures.items():
        amount = F.col(f"`{name}`")
        accepted = F.lit(True)
        if profile.enabled:
            broken = cell_rules(profile, amount, holds_key(F.col("unparsed"), F.lit(label)))
            accepted = F.lit(not month_broken(label, profile)) & row & none_broken(broken)
        if profile.drops_blanks:
            accepted = accepted & amount.isNotNull()
        if present and name in present:
            accepted = present[name] & accepted
        cells[label] = (amount, accepted)
    return cells


def normalize(
    wide: DataFrame,
    profile: Profile | str = "strict_ids",
    pattern: str = SALES_COLUMN_PATTERN,
    identifiers: Sequence[str] = IDENTIFIER_COLUMNS,
    scope: str = "file",
) -> DataFrame:
    """Valid, deduplicated long rows of any wide frame, in the curated column order.

    Without a ``source_file`` the whole frame counts as one file.
    """
    chosen = PROFILES[profile] if isinstance(profile, str) else profile
    ids, measures = identifiers_and_measures(wide.columns, chosen, pattern, identifiers)
    provenance = [c for c in PROVENANCE if c in wide.columns]
    if chosen.dedup and scope == "file":
        typed = typed_wide(wide, ids, measures)
        cells = valid_cells(typed, ids, measures, chosen)
        rows = add_calendar(dedup_wide(typed, [*ids, *provenance], cells), chosen)
    else:
        rows = split(long_rows(wide, chosen, pattern, identifiers))[0].drop("unparsed", "sales_raw")
        if chosen.dedup:
            rows = dedup(rows, [*ids, "month"], scope, determined=DETERMINED)
    return to_output(rows, [c for c in ids if c not in IDENTIFIER_COLUMNS])
