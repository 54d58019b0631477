"""Row validation: named profiles, reasons for every reject, and counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthfold.functions.months import MONTHS
from monthfold.schema import CURATED_NOT_NULL, IDENTIFIER_TYPES, WIDTHS
from monthfold.sources.wide import BEYOND

# Columns that a long row gets from its month alone.
MONTHLY = ("month", "month_number")


@dataclass(frozen=True)
class Profile:
    """One set of validation rules.

    ``null_amount`` is ``keep`` (valid), ``reject`` or ``drop`` (neither valid nor
    rejected). ``required`` columns are checked where the frame has them.
    """

    name: str
    required: tuple[str, ...] = ()
    requires_all_identifiers: bool = False
    null_amount: str = "keep"
    reject_negative: bool = True
    max_amount: Decimal | None = None
    widths: Mapping[str, int] = field(default_factory=dict)
    unknown_month: str = "zero"
    allow_list: bool = False
    dedup: bool = False
    keep_rejects: bool = True
    enabled: bool = True

    @property
    def drops_blanks(self) -> bool:
        """Whether empty cells are left out without being rejects."""
        return self.enabled and self.null_amount == "drop"


PROFILES: dict[str, Profile] = {
    profile.name: profile
    for profile in (
        Profile(
            "strict_ids",
            required=tuple(IDENTIFIER_TYPES),
            requires_all_identifiers=True,
            max_amount=Decimal(1_000_000_000),
            dedup=True,
        ),
        Profile("notebook", required=("salesperson_id",), null_amount="reject", allow_list=True),
        Profile(
            "core_keys",
            required=("salesperson_id", "store_id", "year"),
            null_amount="reject",
            unknown_month="null",
        ),
        Profile(
            "sql_insert",
            required=CURATED_NOT_NULL,
            null_amount="drop",
            reject_negative=False,
            widths=WIDTHS,
            unknown_month="null",
            allow_list=True,
        ),
    )
}


def _holds(condition: Column) -> Column:
    """A condition that is NULL does not hold."""
    return F.coalesce(condition, F.lit(False))


def row_rules(
    columns: Sequence[str],
    profile: Profile,
    ids: Sequence[str] = (),
    present: Mapping[str, Column] | None = None,
) -> list[tuple[str, Column]]:
    """(reason, predicate) pairs about columns that all cells of a row share.

    A required column is checked where the row's file has it: ``present`` tells that
    for columns that only some of the united files have.
    """
    found = []
    for c in profile.required:
        if c in columns and c not in MONTHLY:
            missing = F.col(f"`{c}`").isNull()
            found.append((f"null_{c}", present[c] & missing if present and c in present else missing))
    if "unparsed" in columns:
        names = list(ids) or list(IDENTIFIER_TYPES)
        found.append(
            ("unparseable_identifier", _holds(F.arrays_overlap(F.map_keys("unparsed"), F.lit(names))))
        )
        found.append(("row_beyond_header", holds_key(F.col("unparsed"), BEYOND)))
    found += [
        (f"too_long_{c}", _holds(F.length(F.col(f"`{c}`")) > width))
        for c, width in profile.widths.items()
        if c in columns and c not in MONTHLY
    ]
    return found


def month_rules(columns: Sequence[str], profile: Profile) -> list[tuple[str, Column]]:
    """(reason, predicate) pairs about the month of a long row."""
    found = [(f"null_{c}", F.col(c).isNull()) for c in profile.required if c in columns and c in MONTHLY]
    if "month" in profile.widths and "month" in columns:
        found.append(("too_long_month", _holds(F.length("month") > profile.widths["month"])))
    return found


def month_broken(label: str, profile: Profile) -> bool:
    """What :func:`month_rules` says about every cell of one month column."""
    unnumbered = label not in MONTHS and profile.unknown_month == "null" and "month_number" in profile.required
    return unnumbered or len(label) > profile.widths.get("month", len(label))


def cell_rules(profile: Profile, amount: Column, unparsed: Column | None = None) -> list[tuple[str, Column]]:
    """(reason, predicate) pairs about one amount; ``unparsed`` says that its text is no number."""
    found = []
    blank = amount.isNull()
    if unparsed is not None:
        found.append(("unparseable_amount", unparsed))
        blank = blank & ~unparsed
    if profile.null_amount == "reject":
        found.append(("null_amount", blank))
    if profile.reject_negative:
        found.append(("negative_amount", _holds(amount < 0)))
    if profile.max_amount is not None:
        found.append(("amount_over_max", _holds(amount > F.lit(profile.max_amount))))
    return found


def none_broken(checks: Sequence[tuple[str, Column]]) -> Column:
    """True where no predicate of the checks holds."""
    return ~reduce(or_, [broken for _, broken in checks]) if checks else F.lit(True)


def holds_key(entries: Column, key: Column | str) -> Column:
    """True where a map has the key; a NULL map has none."""
    return _holds(F.map_contains_key(entries, key))


def flag(
    df: DataFrame,
    profile: Profile,
    ids: Sequence[str] = (),
    present: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add ``is_valid`` and ``reject_reasons`` (empty for valid rows) to long rows.

    ``is_valid`` is NULL for null amounts under a profile that drops them, so that
    such rows are on neither side of :func:`split`.
    """
    amount = F.col("sales_amount")
    unparsed = holds_key(F.col("unparsed"), F.col("month")) if "unparsed" in df.columns else None
    checks = []
    if profile.enabled:
        checks = [
            *row_rules(df.columns, profile, ids, present),
            *month_rules(df.columns, profile),
            *cell_rules(profile, amount, unparsed),
        ]
    valid = none_broken(checks)
    none = F.array().cast("array<string>")
    reasons = none
    if checks:
        listed = F.array_compact(F.array(*[F.when(broken, F.lit(reason)) for reason, broken in checks]))
        reasons = F.when(valid, none).otherwise(listed)
    if profile.drops_blanks:
        blank = amount.isNull() if unparsed is None else amount.isNull() & ~unparsed
        valid = F.when(~blank, valid)
    return df.withColumns({"is_valid": valid, "reject_reasons": reasons})


def split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the flags, rejected rows with them)."""
    return df.where(F.col("is_valid")).drop("is_valid", "reject_reasons"), df.where(~F.col("is_valid"))


def metrics(df: DataFrame, by: Sequence[str] = ("source_file",)) -> DataFrame:
    """Counts of flagged rows per group in one pass; the rate of no rows is 0."""
    total = F.count_if(F.col("is_valid").isNotNull())
    valid = F.count_if(F.col("is_valid"))
    counted = df.groupBy(*by).agg(
        total.alias("total_records"),
        valid.alias("valid_records"),
        F.count_if(~F.col("is_valid")).alias("invalid_records"),
    )
    rate = F.col("valid_records").cast("double") / F.col("total_records") * F.lit(100.0)
    return counted.withColumn(
        "validation_rate", F.when(F.col("total_records") > 0, rate).otherwise(F.lit(0.0))
    )
