import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from conftest import SF
from wavemeld.operators.matching import match_columns
from wavemeld.plans.audit import upsert
from wavemeld.queries.maps import WORDS
from wavemeld.queries.registry import table, words, word_log

SAMPLE = ["scan_csv", "scan_csv_text", "scan_orc", "write_merged", "write_dataset_files", "match_log_files", "conformance_many_codes",
          "harmonise_audit", "harmonise_issues", "manifest_scan", "spec_alias_table", "spec_keyword_pattern", "spec_value_table",
          "unique_column_names", "match_fuzzy", "match_columns", "match_report_lines", "recode_values", "coerce_integer",
          "coercion_counts", "value_conformance", "clean_dataset", "merge_mixed_types", "sum_up_category",
          "manifest_separators", "malformed_rows", "malformed_issues", "ragged_merged", "validation_full", "harmonise_codes",
          "conformance_first_codes", "labels_strict_error", "label_attributes", "load_map", "fix_encode_double",
          "audit_master_files", "report_per_dataset", "labels_lenient", "fix_encode_bytes", "harmonise_merged", "safe_coerce", "conformance_report"]


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS FROM '{f}'")
    return con


def test_every_query_has_an_equivalent():
    from wavemeld.queries.oracles import ORACLES
    from wavemeld.queries.registry import QUERIES
    assert set(QUERIES) == set(ORACLES)
    assert set(SAMPLE) <= set(entry_points.queries())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["status", "amount", "priority", "year"] and df.count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_rows_agree_with_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, SF)
    cursor = duck.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    want = Counter(tuple(plain(r[names.index(c)]) for c in order) for r in cursor.fetchall())
    assert Counter(tuple(plain(r[c]) for c in order) for r in df.collect()) == want


def test_invariants(spark):
    log = match_columns(words(spark, SF), WORDS).log
    claimed = log.groupBy("dataset", "canonical").count().filter("count > 1")
    assert claimed.isEmpty()
    master = word_log(spark, SF).drop("ordinal")
    once = upsert(master, master)
    assert once.count() == master.count() and once.exceptAll(master).isEmpty()


def test_input_tables_are_only_read(spark):
    assert table(spark, SF, "region").count() == 5
