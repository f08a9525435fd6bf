import pytest
from pyspark.sql import functions as F

from wavemeld.functions import cells as C
from wavemeld.operators.clean import (apply_casts, apply_missing_codes, apply_recodes, clean_dataset, dedupe_rows,
                                      drop_empty_rows, inject_year, recode_join, rename_columns, select_canonical)
from wavemeld.operators.profile import coercion_profile, conformance_profile, issue_table, profile_cells, undeclared_codes
from wavemeld.spec import Spec


def issues_of(df, spec, columns, **kw):
    types = dict(df.dtypes)
    cells = profile_cells(df, spec, columns, **kw)
    return {(r["variable"], r["issue_type"]): r for r in issue_table(cells, spec, types, columns).collect()}


def test_whole_chain(spark, spec, survey):
    out = clean_dataset(survey, spec, year=2023, label="wave.csv")
    assert out.data.columns == ["kjonn", "alder", "yrkesstatus", "siv", "antpers", "tob1", "year"]
    types = dict(out.data.dtypes)
    assert types["siv"] == "string" and all(types[c] == "int" for c in types if c != "siv")
    assert out.data.count() == 8
    assert {r["year"] for r in out.data.collect()} == {2023}
    methods = {r["raw_name"]: (r["canonical"], r["method"], r["confidence"], r["needs_review"]) for r in out.match}
    assert methods["io_kjonn"] == ("kjonn", "keyword [kjonn]", "low", True)
    assert methods["alder"] == ("alder", "exact", "high", False)
    issues = {r["variable"]: r for r in out.issues.collect()}
    assert set(issues) == {"siv", "tob1"}
    assert issues["siv"]["detail"] == "Target: integer. 1 value(s) -> NA: D. Column kept as character."
    assert issues["tob1"]["detail"] == "Values not declared in YAML: 8, 9. Valid set: 1, 2."
    assert issues["tob1"]["issue_type"] == "unexpected_values"


def test_missing_codes_in_chain(spec, survey):
    rows = clean_dataset(survey, spec, apply_missing=True).data.collect()
    assert sum(r["yrkesstatus"] is None for r in rows) == 2
    assert sum(r["antpers"] is None for r in rows) == 1  # 99 only
    assert sum(r["tob1"] is None for r in rows) == 0


def test_no_year_no_column(spec, survey):
    assert "year" not in clean_dataset(survey, spec).data.columns


def test_rename_and_select(spark, spec):
    df = spark.createDataFrame([(1, 2, 3)], "io_kjonn int, junk int, alder int")
    df = rename_columns(df, {"io_kjonn": "kjonn", "not_there": "siv"})
    assert df.columns == ["kjonn", "junk", "alder"]
    assert select_canonical(df, spec).columns == ["kjonn", "alder"]


def test_recode_keeps_type(spark, spec):
    df = spark.createDataFrame([("0",), ("1",), ("2",), ("x",), (None,)], "kjonn string")
    assert [r[0] for r in apply_recodes(df, spec, ["kjonn"]).collect()] == ["2", "1", "2", "x", None]
    df = spark.createDataFrame([(0.0,), (1.0,), (5.5,)], "kjonn double")
    assert [r[0] for r in apply_recodes(df, spec, ["kjonn"]).collect()] == [2.0, 1.0, 5.5]


def test_long_recode_list_is_a_join(spark):
    spec = Spec.from_dict({"v": {"type": "integer", "recode": {str(i): i + 1000 for i in range(200)}}})
    df = spark.createDataFrame([("7",), ("199",), ("x",), (None,)], "v string")
    out = apply_recodes(df, spec, ["v"])
    assert sorted(r[0] or "" for r in out.collect()) == ["", "1007", "1199", "x"]
    assert recode_join(df, "v", {"7": 1}).count() == 4


def test_missing_codes(spark, spec):
    df = spark.createDataFrame([(1,), (8,), (9,), (2,), (None,)], "yrkesstatus int")
    assert [r[0] for r in apply_missing_codes(df, spec, ["yrkesstatus"]).collect()] == [1, None, None, 2, None]
    df = spark.createDataFrame([(8.0,), (8.5,)], "yrkesstatus double")
    assert [r[0] for r in apply_missing_codes(df, spec, ["yrkesstatus"]).collect()] == [None, 8.5]


@pytest.mark.parametrize("text,want", [
    ("1", 1), ("1.7", 1), ("-1.7", -1), ("1e3", 1000), (" 5 ", 5), ("1d", None), ("x", None), ("", None),
    ("3000000000", None), ("-2147483648", None), ("2147483647", 2147483647), ("inf", None), (".5", 0), (None, None)])
def test_integer_cast(spark, text, want):
    df = spark.createDataFrame([(text,)], "c string")
    assert df.select(C.to_integer(F.col("c"), "string")).first()[0] == want


def test_other_casts(spark):
    df = spark.createDataFrame([("T",), ("TRUE",), ("true",), ("True",), ("F",), ("False",), ("yes",), ("1",)], "c string")
    assert [r[0] for r in df.select(C.to_logical(F.col("c"), "string")).collect()] == [
        True, True, True, True, False, False, None, None]
    df = spark.createDataFrame([(1.0, True), (1.5, False), (float("nan"), None)], "d double, b boolean")
    got = df.select(C.string_form(F.col("d"), "double"), C.string_form(F.col("b"), "boolean"),
                    C.to_logical(F.col("d"), "double")).collect()
    assert [tuple(r) for r in got] == [("1", "TRUE", True), ("1.5", "FALSE", True), (None, None, None)]


def test_coercion_issues(spark):
    spec = Spec.from_dict({"a": {"type": "integer"}, "b": {"type": "datestamp"}, "c": {"type": "integer"}})
    df = spark.createDataFrame([("1", "x", "q1"), ("D", "y", "q2"), ("3", "z", "q3"), ("4", "u", "q4"),
                                ("5", "v", "q5"), ("6", "w", "q6"), ("6", "w", "q6")], "a string, b string, c string")
    found = issues_of(df, spec, ["a", "b", "c"])
    assert found["a", "coercion_failure"]["bad_values"] == ["D"]
    assert found["b", "coercion_skip"]["detail"] == "Unknown target type 'datestamp'; column left as-is."
    c = found["c", "coercion_failure"]
    assert c["n_bad"] == 7 and c["bad_values"] == ["q1", "q2", "q3", "q4", "q5", "..."]
    out = apply_casts(df, spec, ["a", "b", "c"], frozenset({"a", "c"}))
    assert dict(out.dtypes) == {"a": "string", "b": "string", "c": "string"}


def test_cast_that_loses_nothing_is_applied(spark):
    spec = Spec.from_dict({"a": {"type": "integer"}})
    df = spark.createDataFrame([("1",), ("2",), (None,)], "a string")
    out = clean_dataset(df, Spec.from_dict({"a": {"type": "integer", "colnames": ["a"]}}))
    assert dict(out.data.dtypes)["a"] == "int" and not out.kept and spec["a"].type == "integer"


def test_undeclared_codes(spark, spec):
    df = spark.createDataFrame([(1, 1), (2, 2), (99, 8)], "kjonn int, tob1 int")
    found = issues_of(df, spec, ["kjonn", "tob1"])
    assert found["kjonn", "unexpected_values"]["bad_values"] == ["99"]
    assert found["tob1", "unexpected_values"]["bad_values"] == ["8"]
    df = spark.createDataFrame([(1,), (None,), (2,)], "kjonn int")
    assert issues_of(df, spec, ["kjonn"]) == {}


def test_string_codes_are_flagged_only_on_request(spark):
    spec = Spec.from_dict({"s": {"type": "character", "value": {"a": "A", "b": "B"}}})
    df = spark.createDataFrame([("a",), ("zz",)], "s string")
    assert issues_of(df, spec, ["s"]) == {}
    assert issues_of(df, spec, ["s"], check_strings=True)["s", "unexpected_values"]["bad_values"] == ["zz"]


def test_logical_target_decides_the_code(spark):
    spec = Spec.from_dict({"q": {"type": "logical", "value": {0: "no"}}})
    cast = spark.createDataFrame([("T",), ("F",)], "q string")
    assert issues_of(cast, spec, ["q"])["q", "unexpected_values"]["bad_values"] == ["1"]
    kept = spark.createDataFrame([("T",), ("7",)], "q string")
    found = issues_of(kept, spec, ["q"])
    assert found["q", "coercion_failure"]["bad_values"] == ["7"]
    assert found["q", "unexpected_values"]["bad_values"] == ["7"]


def test_codes_sort_by_number(spark):
    spec = Spec.from_dict({"k": {"type": "integer", "value": {1: "x"}}})
    df = spark.createDataFrame([(10,), (9,), (100,), (1,)], "k int")
    assert issues_of(df, spec, ["k"])["k", "unexpected_values"]["bad_values"] == ["9", "10", "100"]


def test_cells_are_whole(spark):
    spec = Spec.from_dict({"k": {"type": "integer", "value": {1: "x"}}})
    df = spark.range(3000).selectExpr("cast(id as int) k")
    cells = profile_cells(df, spec, ["k"])
    assert cells.count() == 2999
    row = conformance_profile(cells).first()
    assert row["n_distinct"] == 2999 and row["n_bad"] == 2999
    assert {r["value"] for r in undeclared_codes(cells).collect()} == {str(i) for i in range(3000) if i != 1}
    detail = issue_table(cells, spec, dict(df.dtypes), ["k"]).first()["detail"]
    first = ", ".join(str(i) for i in range(51) if i != 1)
    assert detail.split(": ")[1].split(". Valid")[0] == first + ", ... (2999 different codes, all in undeclared_codes)"
    assert coercion_profile(cells).count() == 0


def test_year(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert inject_year(df, None).columns == ["a"]
    assert inject_year(df, 2023).first()["year"] == 2023
    assert dict(inject_year(df.withColumn("year", F.lit("x")), 2023).dtypes)["year"] == "int"


def test_rows(spark):
    df = spark.createDataFrame([(1, 2), (None, None), (3, 4)], "a int, b int")
    assert drop_empty_rows(df).count() == 2
    assert drop_empty_rows(inject_year(df, 2023)).count() == 2
    assert drop_empty_rows(inject_year(df, 2023), ignore=()).count() == 3
    df = spark.createDataFrame([(1, 3), (1, 3), (2, 4), (None, None), (None, None)], "a int, b int")
    assert dedupe_rows(df).count() == 3


def test_column_that_already_has_the_name(spark, spec):
    # kjonn2 has no candidate; sex is a keyword hit; the alias column wins the name.
    df = spark.createDataFrame([(1, 2)], "kjonn int, sex int")
    assert clean_dataset(df, spec).data.first().asDict() == {"kjonn": 1}
