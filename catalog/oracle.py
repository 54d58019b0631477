"""The SQL each query is checked against, over the same sample tables."""

from __future__ import annotations

import hashlib
import json

from catalog.tables import DELIVERIES, IDS, MEASURES
from monthfold.functions.months import MONTHS

_IDS = ", ".join(IDS)
_IN = ", ".join(f"{measure} AS '{month}'" for measure, month in zip(MEASURES, MONTHS))
_LONG = f"{_IDS}, month, month_number, CAST(sales_amount AS DOUBLE) AS sales_amount, quarter, source_file"
_NUMBER = "CASE month " + " ".join(f"WHEN '{m}' THEN {n}" for n, m in enumerate(MONTHS, start=1)) + "{other} END"
_QUARTER = "CAST(CEIL(month_number / 3.0) AS INTEGER)"

_LINES = """lines AS (
  SELECT CAST(s_suppkey AS INTEGER) AS salesperson_id, s_name AS salesperson_name,
         CAST(n_nationkey AS INTEGER) AS sales_state_id, n_name AS sales_state_name,
         CASE WHEN p_brand <> 'Brand#13' THEN CAST(substr(p_brand, 7) AS INTEGER) END AS store_id,
         p_brand AS store_name, CAST(year(l_shipdate) AS INTEGER) AS year,
         CAST(month(l_shipdate) AS INTEGER) AS m,
         CAST(l_extendedprice AS DECIMAL(18,2)) * CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS amount,
         'sales_' || l_returnflag || '.csv' AS line_file
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
       JOIN part ON l_partkey = p_partkey)"""
_CELLS = ", ".join(
    f"CAST(SUM(amount) FILTER (WHERE m = {n}) AS DECIMAL(18,2)) AS {measure}"
    for n, measure in enumerate(MEASURES, start=1)
)
_WIDE = f"{_LINES}, w AS (SELECT {_IDS}, {_CELLS} FROM lines GROUP BY {_IDS})"


def _long_cte(source: str = "w", extra: str = "", other: str = " ELSE 0") -> str:
    number = f"CAST({_NUMBER.format(other=other)} AS INTEGER)"
    return f"""l AS (
  SELECT {_IDS}, month, month_number, sales_amount, {_QUARTER} AS quarter,
         'sales_' || year || '.csv' AS source_file
  FROM (SELECT *, {number} AS month_number
        FROM {source} UNPIVOT INCLUDE NULLS (sales_amount FOR month IN ({_IN}{extra}))))"""


def _with_long(select: str) -> str:
    return f"WITH {_WIDE}, {_long_cte()} {select}"


def _with_wide(select: str) -> str:
    return f"WITH {_WIDE} {select}"


_LABEL = "CASE m " + " ".join(f"WHEN {n} THEN '{month}'" for n, month in enumerate(MONTHS, start=1)) + " END"
_REPEATED = f"""{_LINES}, r AS (
  SELECT {_IDS}, {_LABEL} AS month, m AS month_number, CAST(amount AS DECIMAL(18,2)) AS sales_amount,
         CAST(CEIL(m / 3.0) AS INTEGER) AS quarter, line_file AS source_file FROM lines)"""
_KEYS = f"{_IDS}, month"


def _span(first: int | None, last: int | None) -> str:
    bounds = ([f"year >= {first}"] if first else []) + ([f"year <= {last}"] if last else [])
    return " AND ".join(bounds)


# The long cells again, now named after the delivery file that carries them.
_FILES = "CASE " + " ".join(
    f"WHEN {_span(first, last)} AND month IN ({', '.join(repr(m) for m in months)}) THEN '{name}'"
    for name, first, last, months in DELIVERIES
) + " END"
_DELIVERED = f"d AS (SELECT * REPLACE ({_FILES} AS source_file) FROM l)"
# Wide rows per delivery file.
_PER_FILE = "f AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS source_file, COUNT(*) AS records FROM w WHERE {_span(first, last)}"
    for name, first, last, _ in DELIVERIES
) + ")"


def _with_delivered(select: str) -> str:
    return f"WITH {_WIDE}, {_long_cte()}, {_DELIVERED}, {_PER_FILE} {select}"


_NULL_ID = "(" + " OR ".join(f"{c} IS NULL" for c in IDS) + ")"
_BAD_STRICT = f"({_NULL_ID} OR COALESCE(sales_amount < 0, FALSE) OR COALESCE(sales_amount > 200000, FALSE))"
_BAD_NOTEBOOK = "(salesperson_id IS NULL OR sales_amount IS NULL OR sales_amount < 0)"
_BAD_CORE = "(salesperson_id IS NULL OR store_id IS NULL OR year IS NULL OR sales_amount IS NULL OR sales_amount < 0)"
_REASONS = "concat_ws(',', " + ", ".join(
    [f"CASE WHEN {c} IS NULL THEN 'null_{c}' END" for c in IDS]
    + [
        "{null_amount}CASE WHEN sales_amount < 0 THEN 'negative_amount' END",
        "CASE WHEN sales_amount > 200000 THEN 'amount_over_max' END",
    ]
) + ")"
_STRICT_REASONS = _REASONS.format(null_amount="")
_ALL_REASONS = _REASONS.format(null_amount="CASE WHEN sales_amount IS NULL THEN 'null_amount' END, ")

_SUM = "CAST(SUM(sales_amount) AS DOUBLE)"
_AVG = "CAST(SUM(sales_amount) AS DOUBLE) / COUNT(sales_amount)"
_EXTREMES = "CAST(MIN(sales_amount) AS DOUBLE) AS min_sales, CAST(MAX(sales_amount) AS DOUBLE) AS max_sales"
_STATISTICS = f"""COUNT(*) AS total_records, COUNT(DISTINCT salesperson_id) AS unique_salespeople,
  COUNT(DISTINCT store_id) AS unique_stores, COUNT(DISTINCT sales_state_id) AS unique_states,
  {_SUM} AS total_sales, {_AVG} AS avg_sales, {_EXTREMES}"""
_MONTH_LIST = "array_to_string(list_sort(list(DISTINCT month)), ',') AS months_covered"

_UNPIVOT_KEEP = f"SELECT {_IDS}, month, CAST(sales_amount AS DOUBLE) AS sales_amount FROM {{frame}} UNPIVOT INCLUDE NULLS (sales_amount FOR month IN ({_IN}))"
_UNPIVOT_DROP = f"SELECT {_IDS}, month, CAST(sales_amount AS DOUBLE) AS sales_amount FROM w UNPIVOT (sales_amount FOR month IN ({_IN}))"
_UNION = " UNION ALL ".join(
    f"SELECT {_IDS}, '{month}' AS month, {n} AS month_number, CAST({month}_sales AS DOUBLE) AS sales_amount, "
    f"{(n + 2) // 3} AS quarter FROM w WHERE {month}_sales IS NOT NULL"
    for n, month in enumerate(MONTHS, start=1)
)
_FOO = ", Foo_sales AS 'Foo'"
_WITH_FOO = "w_foo AS (SELECT *, Jan_sales AS Foo_sales FROM w)"
_TEXT = "t AS (SELECT " + _IDS + ", " + ", ".join(
    f"COALESCE(CAST({m} AS VARCHAR), 'N/A') AS {m}" for m in MEASURES
) + " FROM w)"
_PARSED = ", ".join(f"CAST(TRY_CAST({m} AS DECIMAL(18,2)) AS DOUBLE) AS {m}" for m in MEASURES)
_SHAPES = " UNION ALL BY NAME ".join(
    f"SELECT {_IDS}, {', '.join(f'CAST({m}_sales AS DOUBLE) AS {m}_sales' for m in months)}, "
    f"'{name}' AS source_file FROM w WHERE {_span(first, last)}"
    for name, first, last, months in DELIVERIES
)


def _by_quarter(source: str) -> str:
    return f"""SELECT year, quarter, {_SUM} AS total_sales, COUNT(DISTINCT salesperson_id) AS active_salespeople,
      COUNT(DISTINCT store_id) AS active_stores FROM {source} GROUP BY year, quarter"""


def _by_state(source: str) -> str:
    return f"""SELECT sales_state_id, sales_state_name, year, month, {_SUM} AS total_sales,
      COUNT(DISTINCT store_id) AS store_count FROM {source}
      GROUP BY sales_state_id, sales_state_name, year, month"""


def _ranked(partition: str, tie: str) -> str:
    return f"""WITH {_REPEATED} SELECT {_LONG} FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY {partition} ORDER BY sales_amount DESC NULLS LAST{tie}) AS rn FROM r)
      WHERE rn = 1"""


def _shape_rows() -> dict[tuple[str, ...], list[str]]:
    shapes: dict[tuple[str, ...], list[str]] = {}
    for name, _, _, months in DELIVERIES:
        shapes.setdefault(tuple(f"{m}_sales" for m in months), []).append(name)
    return shapes


def _registry() -> str:
    rows = []
    for measures, names in _shape_rows().items():
        columns = sorted([*IDS, *measures])
        key = hashlib.sha256(json.dumps(columns, separators=(",", ":")).encode()).hexdigest()
        files = ", ".join(f"'{name}'" for name in names)
        rows.append(
            f"SELECT '{key}' AS schema_key, 'cols_{len(columns)}_sales_{len(measures)}' AS count_key, "
            f"'{','.join(sorted(measures))}' AS sales_columns, {len(columns)} AS column_count, "
            f"'{min(names)}' AS first_file, "
            f"(SELECT CAST(SUM(records) AS BIGINT) FROM f WHERE source_file IN ({files})) AS records"
        )
    return _with_delivered(" UNION ALL ".join(rows))


def _drift() -> str:
    rows = []
    for measures, names in _shape_rows().items():
        if len(measures) == 12:
            continue
        removed = ",".join(sorted(set(MEASURES) - set(measures)))
        rows.append(
            f"SELECT source_file, 'new_schema_detected' AS event, '{','.join(sorted(measures))}' AS new_columns, "
            f"'' AS added_columns, '{removed}' AS removed_columns, records FROM f WHERE source_file = '{names[0]}'"
        )
    return _with_delivered(" UNION ALL ".join(rows))


_RUN_TOTALS = f"""SELECT CAST({len(DELIVERIES)} AS BIGINT) AS files_discovered,
  CAST({len(DELIVERIES)} AS BIGINT) AS files_processed, CAST(0 AS BIGINT) AS files_skipped,
  (SELECT CAST(SUM(records) AS BIGINT) FROM f) AS input_records, COUNT(*) AS long_records,
  COUNT(*) FILTER (WHERE NOT {_BAD_STRICT}) AS valid_records,
  COUNT(*) FILTER (WHERE {_BAD_STRICT}) AS invalid_records,
  CAST(0 AS BIGINT) AS duplicates_removed, COUNT(*) FILTER (WHERE NOT {_BAD_STRICT}) AS total_records FROM d"""
_DELIVERED_VALID = _with_delivered(f"SELECT {_LONG} FROM d WHERE NOT {_BAD_STRICT}")
_REPORTED = "year, quarter, month, sales_state_id, sales_state_name, salesperson_id, store_id, sales_amount"
# Rows after a run over the deliveries and one over a file of the years from 1998.
_TWO_RUNS = f"""(SELECT {_REPORTED} FROM d WHERE NOT {_BAD_STRICT}
  UNION ALL SELECT {_REPORTED} FROM l WHERE year >= 1998 AND NOT {_BAD_STRICT})"""
_LONG_ROWS = _with_long(f"SELECT {_LONG} FROM l")

_VALID = "(sales_amount >= 0 AND sales_amount <= 200000)"
_NO_ID = " OR ".join(f"r.{c} IS NULL" for c in IDS)
_CALENDAR = "c(label, number) AS (VALUES " + ", ".join(f"('{m}', {i})" for i, m in enumerate(MONTHS, start=1)) + ")"
# Each line has a cell for each month: its own, and eleven empty ones.
_CELLS = f"""WITH {_REPEATED}, {_CALENDAR}, cells AS (
  SELECT {", ".join(f"r.{c}" for c in IDS)}, label AS month, number AS month_number,
         CASE WHEN r.month = label THEN sales_amount END AS sales_amount,
         NOT ({_NO_ID}) AND (r.month <> label OR {_VALID}) AS valid FROM r CROSS JOIN c),
k AS (SELECT {_IDS}, month, month_number, CAST(MAX(sales_amount) AS DOUBLE) AS sales_amount, COUNT(*) AS n
  FROM cells WHERE valid GROUP BY ALL)"""

ORACLE: dict[str, str] = {
    "ingest_with_repeats": f"{_CELLS} SELECT {_IDS}, month, month_number, sales_amount FROM k",
    "repeats_removed": f"""{_CELLS} SELECT (SELECT COUNT(*) FROM r) AS input_records, (SELECT COUNT(*) FROM cells) AS long_records,
      CAST(SUM(n) AS BIGINT) AS valid_records, CAST(SUM(n - 1) AS BIGINT) AS duplicates_removed, COUNT(*) AS total_records FROM k""",
    "surrogate_keys_over_runs": _with_delivered(
        f"""SELECT month, COUNT(*) AS records, COUNT(*) AS keys, CAST(0 AS BIGINT) AS bad_keys FROM (
          SELECT month FROM d WHERE NOT {_BAD_STRICT} UNION ALL SELECT month FROM l WHERE year >= 1996 AND NOT {_BAD_STRICT})
        GROUP BY month"""
    ),
    "global_scope_on_write": _with_delivered(
        f"""SELECT {_IDS}, month, CAST(MAX(sales_amount) AS DOUBLE) AS sales_amount FROM (
          SELECT {_IDS}, month, sales_amount FROM d WHERE NOT {_BAD_STRICT}
          UNION ALL
          SELECT {_IDS}, month, sales_amount FROM (
            SELECT * REPLACE (CAST(sales_amount + 1 AS DECIMAL(18, 2)) AS sales_amount) FROM l WHERE year >= 1999)
          WHERE NOT {_BAD_STRICT})
        GROUP BY {_IDS}, month"""
    ),
    "full_refresh_replaces": _with_long(
        f"""SELECT {_IDS}, month, CAST(sales_amount AS DOUBLE) AS sales_amount, 'sales_refreshed.csv' AS source_file
        FROM l WHERE year >= 1996 AND NOT {_BAD_STRICT}"""
    ),
    "unpivot_keep_nulls": _with_wide(_UNPIVOT_KEEP.format(frame="w")),
    "unpivot_drop_nulls": _with_wide(_UNPIVOT_DROP),
    "unpivot_union_all": _with_wide(_UNION),
    "unpivot_sql": _with_wide(_UNPIVOT_DROP),
    "month_subset_unpivot": _with_wide(
        f"SELECT * FROM ({_UNPIVOT_KEEP.format(frame='w')}) WHERE month IN ('Jan', 'Jun', 'Dec')"
    ),
    "month_quarter_derivation": _with_long(
        "SELECT month, month_number, quarter, COUNT(*) AS records FROM l GROUP BY month, month_number, quarter"
    ),
    "unknown_month_zero": f"WITH {_WIDE}, {_WITH_FOO}, {_long_cte('w_foo', _FOO)} SELECT {_LONG} FROM l",
    "unknown_month_null": f"WITH {_WIDE}, {_WITH_FOO}, {_long_cte('w_foo', _FOO, '')} SELECT {_LONG} FROM l",
    "lateral_month_number": _with_long(
        f"SELECT {_IDS}, month, CAST(sales_amount AS DOUBLE) AS sales_amount, month_number FROM l "
        "WHERE sales_amount IS NOT NULL"
    ),
    "allow_list_projection": _with_wide(_UNPIVOT_KEEP.format(frame="(SELECT *, sales_state_name AS region FROM w)")),
    "extra_identifier_kept": _with_wide(
        f"SELECT *, sales_state_name AS region FROM ({_UNPIVOT_KEEP.format(frame='w')})"
    ),
    "measures_try_cast": f"WITH {_WIDE}, {_TEXT} SELECT {_IDS}, {_PARSED} FROM t",
    "unparseable_amounts": _with_long(
        f"""SELECT {_IDS}, month, CASE WHEN sales_amount IS NULL THEN 'N/A' END AS sales_raw,
          CASE WHEN sales_amount IS NULL THEN 'unparseable_amount' ELSE 'negative_amount' END AS reject_reasons
          FROM l WHERE sales_amount IS NULL OR sales_amount < 0"""
    ),
    "melt_column_order": _with_long(
        " UNION ALL ".join(
            f"SELECT {i} AS position, '{c}' AS name, COUNT({c}) AS n FROM l"
            for i, c in enumerate([*IDS, "source_file", "sales_amount", "month", "month_number", "quarter"])
        )
    ),
    "union_shapes_by_name": _with_wide(_SHAPES),
    "normalize_all_shapes": _DELIVERED_VALID,
    "valid_strict_ids": _with_long(f"SELECT {_LONG} FROM l WHERE NOT {_BAD_STRICT}"),
    "invalid_strict_ids": _with_long(f"SELECT {_LONG} FROM l WHERE {_BAD_STRICT}"),
    "valid_notebook": _with_long(f"SELECT {_LONG} FROM l WHERE NOT {_BAD_NOTEBOOK}"),
    "invalid_notebook": _with_long(f"SELECT {_LONG} FROM l WHERE {_BAD_NOTEBOOK}"),
    "valid_core_keys": _with_long(f"SELECT {_LONG} FROM l WHERE NOT {_BAD_CORE}"),
    "invalid_core_keys": _with_long(f"SELECT {_LONG} FROM l WHERE {_BAD_CORE}"),
    "valid_sql_insert": _with_long(f"SELECT {_LONG} FROM l WHERE sales_amount IS NOT NULL"),
    "negative_allowed": _with_long(
        f"SELECT {_LONG} FROM l WHERE NOT ({_NULL_ID} OR COALESCE(sales_amount > 200000, FALSE))"
    ),
    "validation_disabled": _LONG_ROWS,
    "reject_reasons": _with_long(
        f"SELECT {_LONG}, NOT ({_BAD_STRICT} OR sales_amount IS NULL) AS is_valid, "
        f"{_ALL_REASONS} AS reject_reasons FROM l"
    ),
    "validation_metrics": _with_long(
        f"""SELECT source_file, COUNT(*) AS total_records, COUNT(*) FILTER (WHERE NOT {_BAD_STRICT}) AS valid_records,
          COUNT(*) FILTER (WHERE {_BAD_STRICT}) AS invalid_records,
          CAST(COUNT(*) FILTER (WHERE NOT {_BAD_STRICT}) AS DOUBLE) / COUNT(*) * 100.0 AS validation_rate
          FROM l GROUP BY source_file"""
    ),
    "not_null_check": f"WITH {_WIDE}, {_WITH_FOO}, {_long_cte('w_foo', _FOO, '')} SELECT "
    + ", ".join(
        f"COUNT(*) FILTER (WHERE {c} IS NULL) AS null_{c}" for c in ("salesperson_id", "year", "month", "month_number")
    )
    + " FROM l",
    "width_check": _with_long(
        "SELECT "
        + ", ".join(
            f"COUNT(*) FILTER (WHERE length({c}) > {n}) AS too_long_{c}"
            for c, n in (("salesperson_name", 100), ("sales_state_name", 10), ("store_name", 7), ("month", 3))
        )
        + " FROM l"
    ),
    "key_uniqueness": _with_long(
        "SELECT COUNT(*) AS records, COUNT(*) AS distinct_keys, CAST(0 AS BIGINT) AS null_keys FROM l"
    ),
    "dedup_within_file": _ranked(f"{_KEYS}, source_file", ""),
    "dedup_global": _ranked(_KEYS, ", source_file DESC"),
    "dedup_removed_count": f"""WITH {_REPEATED}, g AS (SELECT COUNT(*) AS n FROM r GROUP BY {_KEYS}, source_file)
      SELECT CAST(SUM(n) AS BIGINT) AS records_before, COUNT(*) AS records_after,
             CAST(SUM(n - 1) AS BIGINT) AS records_removed FROM g""",
    "duplicate_keys": f"""WITH {_REPEATED} SELECT salesperson_id, store_id, year, month, COUNT(*) AS duplicate_count
      FROM r GROUP BY salesperson_id, store_id, year, month HAVING COUNT(*) > 1""",
    "sales_by_quarter": _with_long(_by_quarter("l")),
    "quarter_totals": _with_long(f"SELECT year, quarter, {_SUM} AS total_sales FROM l GROUP BY year, quarter"),
    "sales_by_salesperson": _with_long(
        f"""SELECT salesperson_id, salesperson_name, year, {_SUM} AS total_sales, {_AVG} AS avg_monthly_sales,
          CAST(MAX(sales_amount) AS DOUBLE) AS max_monthly_sales, CAST(MIN(sales_amount) AS DOUBLE) AS min_monthly_sales
          FROM l GROUP BY salesperson_id, salesperson_name, year"""
    ),
    "sales_by_state": _with_long(_by_state("l")),
    "null_key_audit": _with_wide(
        " UNION ALL ".join(
            f"SELECT 'Null {c}' AS issue, COUNT(*) AS count FROM w WHERE {c} IS NULL"
            for c in ("salesperson_id", "store_id", "year")
        )
    ),
    "negative_by_month": _with_long(
        "SELECT month, COUNT(*) AS negative_count FROM l WHERE sales_amount < 0 GROUP BY month"
    ),
    "summary_stats": _with_long(f"SELECT {_STATISTICS}, COUNT(DISTINCT month) AS months_covered FROM l"),
    "summary_months_list": _with_long(f"SELECT {_STATISTICS}, {_MONTH_LIST} FROM l"),
    "top10_salespeople": _with_long(
        f"""SELECT salesperson_id, salesperson_name, {_SUM} AS total_sales FROM l
          GROUP BY salesperson_id, salesperson_name ORDER BY SUM(sales_amount) DESC, salesperson_id LIMIT 10"""
    ),
    "top10_states": _with_long(
        f"""SELECT sales_state_name, {_SUM} AS total_sales FROM l GROUP BY sales_state_name
          ORDER BY SUM(sales_amount) DESC, sales_state_name LIMIT 10"""
    ),
    "record_count": _with_long("SELECT COUNT(*) AS count FROM l"),
    "null_cells_in_aggregates": _with_long(
        f"""SELECT month, COUNT(*) AS total_records, COUNT(sales_amount) AS records_with_amount,
          {_SUM} AS total_sales, {_AVG} AS avg_sales, {_EXTREMES} FROM l GROUP BY month"""
    ),
    "sample_rows": _with_long(
        f"SELECT {_LONG} FROM l ORDER BY salesperson_id, store_name, year, month_number LIMIT 5"
    ),
    "curated_roundtrip_partitioned": _LONG_ROWS,
    "partition_pruned_read": _with_long(_by_state("(SELECT * FROM l WHERE month = 'Jan' AND year >= 1998)")),
    "dynamic_overwrite": _with_long(
        f"""SELECT * REPLACE (CASE WHEN quarter = 1 THEN sales_amount * 2 ELSE sales_amount END AS sales_amount)
          FROM (SELECT {_LONG} FROM l)"""
    ),
    "quarantine_roundtrip": _with_long(f"SELECT {_LONG}, {_STRICT_REASONS} AS reject_reasons FROM l WHERE {_BAD_STRICT}"),
    "csv_export_roundtrip": _LONG_ROWS,
    "parquet_export_roundtrip": _LONG_ROWS,
    "table_append_roundtrip": _LONG_ROWS,
    "saved_table_roundtrip": _LONG_ROWS,
    "curated_schema_and_views": _with_long(_by_state("l")),
    "known_headers_one_scan_per_shape": _DELIVERED_VALID,
    "provenance_columns": _with_delivered(
        "SELECT source_file, records, CAST(1 AS BIGINT) AS load_times FROM f"
    ),
    "discover_new_files": _with_delivered(
        "SELECT source_file, records FROM f WHERE starts_with(source_file, 'sales_from_2001')"
    ),
    "ledger_retry_failed": _with_delivered(
        "SELECT source_file, records FROM f WHERE contains(source_file, 'apr_jun') OR contains(source_file, '1997')"
    ),
    "schema_registry_state": _registry(),
    "drift_events": _drift(),
    "known_measures": _with_long(
        "SELECT month || '_sales' AS sales_column, COUNT(sales_amount) AS cells FROM l GROUP BY month"
    ),
    "no_measure_columns": _with_wide(
        "SELECT COUNT(*) AS wide_rows, CAST(0 AS BIGINT) AS long_records, CAST(1 AS BIGINT) AS drift_events FROM w"
    ),
    "ingest_full_run": _DELIVERED_VALID,
    "ingest_rejects": _with_delivered(
        f"SELECT {_LONG}, {_STRICT_REASONS} AS reject_reasons FROM d WHERE {_BAD_STRICT}"
    ),
    "ingest_twice": _with_delivered(_by_quarter(f"(SELECT * FROM d WHERE NOT {_BAD_CORE})")),
    "run_metrics": _with_delivered(_RUN_TOTALS),
    "ledger_state": _with_delivered(
        f"""SELECT f.source_file, 'success' AS status, f.records AS record_count, c.long_records, c.valid_records,
          c.invalid_records FROM f JOIN (
            SELECT source_file, COUNT(*) AS long_records, COUNT(*) FILTER (WHERE NOT {_BAD_STRICT}) AS valid_records,
                   COUNT(*) FILTER (WHERE {_BAD_STRICT}) AS invalid_records FROM d GROUP BY source_file) c
          ON f.source_file = c.source_file"""
    ),
    "sales_by_quarter_from_summaries": _with_delivered(_by_quarter(_TWO_RUNS)),
    "sales_by_state_from_summaries": _with_delivered(_by_state(_TWO_RUNS)),
    "summary_stats_from_summaries": _with_delivered(
        f"SELECT {_STATISTICS}, COUNT(DISTINCT month) AS months_covered FROM {_TWO_RUNS}"
    ),
    "summary_sink": _with_delivered(
        f"""SELECT {_STATISTICS}, {_MONTH_LIST}, CAST({len(DELIVERIES)} AS BIGINT) AS files_processed
          FROM d WHERE NOT {_BAD_CORE}"""
    ),
    "stream_available_now": _DELIVERED_VALID,
}
