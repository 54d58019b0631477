"""The profile table, cell by cell."""

from dataclasses import replace
from decimal import Decimal

import pytest

from monthfold.operators.validate import PROFILES, flag, metrics, split

SCHEMA = (
    "salesperson_id int, salesperson_name string, sales_state_id int, sales_state_name string, store_id int, "
    "store_name string, year int, month string, month_number int, sales_amount decimal(18,2), source_file string"
)
GOOD = dict(
    salesperson_id=1, salesperson_name="Ann", sales_state_id=2, sales_state_name="TX", store_id=3, store_name="S",
    year=2025, month="Jan", month_number=1, sales_amount=Decimal("10.00"), source_file="sales_a.csv",
)
KEEP, REJECT, DROP = True, False, None
CASES = {
    "good": ({}, dict(strict_ids=KEEP, notebook=KEEP, core_keys=KEEP, sql_insert=KEEP)),
    "null salesperson_id": (
        dict(salesperson_id=None), dict(strict_ids=REJECT, notebook=REJECT, core_keys=REJECT, sql_insert=REJECT)
    ),
    "null salesperson_name": (
        dict(salesperson_name=None), dict(strict_ids=REJECT, notebook=KEEP, core_keys=KEEP, sql_insert=KEEP)
    ),
    "null state id": (
        dict(sales_state_id=None), dict(strict_ids=REJECT, notebook=KEEP, core_keys=KEEP, sql_insert=KEEP)
    ),
    "null state name": (
        dict(sales_state_name=None), dict(strict_ids=REJECT, notebook=KEEP, core_keys=KEEP, sql_insert=KEEP)
    ),
    "null store_id": (
        dict(store_id=None), dict(strict_ids=REJECT, notebook=KEEP, core_keys=REJECT, sql_insert=KEEP)
    ),
    "null store_name": (
        dict(store_name=None), dict(strict_ids=REJECT, notebook=KEEP, core_keys=KEEP, sql_insert=KEEP)
    ),
    "null year": (dict(year=None), dict(strict_ids=REJECT, notebook=KEEP, core_keys=REJECT, sql_insert=REJECT)),
    "null amount": (
        dict(sales_amount=None), dict(strict_ids=KEEP, notebook=REJECT, core_keys=REJECT, sql_insert=DROP)
    ),
    "negative": (
        dict(sales_amount=Decimal("-3")), dict(strict_ids=REJECT, notebook=REJECT, core_keys=REJECT, sql_insert=KEEP)
    ),
    "zero": (dict(sales_amount=Decimal(0)), dict(strict_ids=KEEP, notebook=KEEP, core_keys=KEEP, sql_insert=KEEP)),
    "at the bound": (
        dict(sales_amount=Decimal("1000000000")), dict(strict_ids=KEEP, notebook=KEEP, core_keys=KEEP, sql_insert=KEEP)
    ),
    "over the bound": (
        dict(sales_amount=Decimal("1000000000.01")),
        dict(strict_ids=REJECT, notebook=KEEP, core_keys=KEEP, sql_insert=KEEP),
    ),
    "null month number": (
        dict(month="Foo", month_number=None), dict(strict_ids=KEEP, notebook=KEEP, core_keys=KEEP, sql_insert=REJECT)
    ),
    "long name": (
        dict(store_name="x" * 101), dict(strict_ids=KEEP, notebook=KEEP, core_keys=KEEP, sql_insert=REJECT)
    ),
}


@pytest.fixture(scope="module")
def rows(spark):
    data = []
    for name, (changes, _) in CASES.items():
        values = {**GOOD, **changes, "source_file": name}
        data.append(tuple(values[field.split()[0]] for field in SCHEMA.split(", ")))
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize("profile", sorted(PROFILES))
def test_profile_table(rows, profile):
    got = {row.source_file: row.is_valid for row in flag(rows, PROFILES[profile]).collect()}
    assert got == {name: expected[profile] for name, (_, expected) in CASES.items()}


@pytest.mark.parametrize("profile", sorted(PROFILES))
def test_reasons_agree_with_validity(rows, profile):
    for row in flag(rows, PROFILES[profile]).collect():
        if row.is_valid is not None:
            assert row.is_valid == (row.reject_reasons == [])


def test_reasons_name_every_broken_rule(spark):
    bad = {**GOOD, "salesperson_id": None, "store_name": None, "sales_amount": Decimal("-1")}
    df = spark.createDataFrame([tuple(bad[f.split()[0]] for f in SCHEMA.split(", "))], SCHEMA)
    reasons = flag(df, PROFILES["strict_ids"]).head().reject_reasons
    assert reasons == ["null_salesperson_id", "null_store_name", "negative_amount"]


def test_switches(rows):
    strict = PROFILES["strict_ids"]
    lenient = {r.source_file: r.is_valid for r in flag(rows, replace(strict, reject_negative=False)).collect()}
    assert lenient["negative"] is True
    off = flag(rows, replace(strict, enabled=False)).collect()
    assert all(r.is_valid and r.reject_reasons == [] for r in off)


def test_missing_identifier_columns_are_ignored(rows):
    df = rows.drop("sales_state_id", "store_name")
    got = {r.source_file: r.is_valid for r in flag(df, PROFILES["strict_ids"]).collect()}
    assert got["null state id"] is True and got["null store_name"] is True and got["null year"] is False


def test_split_and_metrics_add_up(rows):
    for profile in PROFILES.values():
        flagged = flag(rows, profile)
        valid, rejected = split(flagged)
        row = metrics(flagged, by=()).head()
        assert (row.valid_records, row.invalid_records) == (valid.count(), rejected.count())
        assert row.total_records == row.valid_records + row.invalid_records
        assert row.validation_rate == row.valid_records / row.total_records * 100


def test_rate_of_nothing_is_zero(rows):
    row = metrics(flag(rows.where("false"), PROFILES["strict_ids"]), by=()).head()
    assert (row.total_records, row.validation_rate) == (0, 0.0)
