"""`normalize` over what `read_wide` gives: the path of one file."""

import pytest
from test_sources import put

from monthfold.operators.validate import PROFILES, split
from monthfold.plans.normalize import long_rows, normalize
from monthfold.sources.discovery import list_files, read_headers
from monthfold.sources.wide import group_by_header, read_wide

TEXT = """salesperson_id,salesperson_name,sales_state_id,sales_state_name,store_id,store_name,year,Jan_sales,Feb_sales
1,Ann,1,TX,5,S5,2025,10,20
2,Bob,1,TX,6,S6,2025,30,40,50
"""


def scanned(spark, folder):
    put(folder, "sales_one.csv", TEXT)
    headers = read_headers(spark, [row.path for row in list_files(spark, str(folder)).collect()])
    (shape,) = group_by_header(headers)
    return read_wide(spark, shape, str(folder))


@pytest.mark.parametrize("profile", sorted(PROFILES))
def test_a_scanned_file_in_every_profile(spark, tmp_path, profile):
    rows = normalize(scanned(spark, tmp_path), profile)
    assert not [name for name in rows.columns if name.startswith("__")]
    found = sorted((r.salesperson_id, r.month, str(r.sales_amount)) for r in rows.collect())
    assert found == [(1, "Feb", "20.00"), (1, "Jan", "10.00")]


@pytest.mark.parametrize("profile", sorted(PROFILES))
def test_a_row_beyond_its_header_is_a_reject(spark, tmp_path, profile):
    rejects = split(long_rows(scanned(spark, tmp_path), PROFILES[profile]))[1].collect()
    assert {(r.salesperson_id, r.month, tuple(r.reject_reasons)) for r in rejects} == {
        (2, "Feb", ("row_beyond_header",)),
        (2, "Jan", ("row_beyond_header",)),
    }
