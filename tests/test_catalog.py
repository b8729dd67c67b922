import os

import duckdb
import pytest

import __spark_entry__ as entry
from contactmill.plans import catalog

CHECKED = (
    "clean_text_docs name_case iso_dates email_norm_contacts phone_norm_formats pct_half_even source_union_map uid_dedup "
    "exclusion_reasons suspect_flags clean_rows check_unique slug_names escape_pages "
    "csv_scan csv_records header_check separator_guard source_match settings_read settings_refused report_tables review_rows "
    "excluded_written check_lost_keys check_formats check_ids check_repeats synth_kinds"
).split()


@pytest.fixture(scope="module")
def duck(tiny):
    con = duckdb.connect()
    for file in os.listdir(tiny):
        con.sql(f"create view {file.split('.')[0]} as select * from read_parquet('{tiny}/{file}')")
    return con


def canonical(rows):
    return sorted(tuple("" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", CHECKED)
def test_against_sql(spark, tiny, duck, name):
    got = catalog.QUERIES[name](spark, tiny)
    want = duck.sql(catalog.SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    order = ", ".join(f'"{c}"' for c in columns)
    assert canonical(got.select(*columns).collect()) == canonical(want.project(order).fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(catalog.SQL) == len(catalog.QUERIES)
