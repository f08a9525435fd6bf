import pytest
from pyspark.sql import functions as F

import wavemeld as wm
from wavemeld.functions.encoding import fix_bytes, fix_double_encoding, fix_encode
from wavemeld.operators.labels import apply_labels, codebook_counts, extract_attr, undeclared_labels
from wavemeld.operators.merge import merge_datasets, widest
from wavemeld.operators.summary import sum_up
from wavemeld.operators.profile import issue_table, profile_cells
from wavemeld.operators.validate import conformance_codes, conformance_report, missingness, validate_dataset, validate_structure
from wavemeld.spec import Spec

SEX = Spec.from_dict({"kjonn": {"label": "Sex", "type": "integer", "value": {1: "Mann", 2: "Kvinne"}}})


@pytest.mark.parametrize("dtype", ["double", "int", "string"])
def test_sum_up(spark, dtype):
    df = spark.createDataFrame([(1,), (2,), (1,), (2,), (1,)], "kjonn int").select(F.col("kjonn").cast(dtype))
    got = {float(r["kjonn"]): (r["n"], r["pct"]) for r in sum_up(df, "kjonn", SEX).collect()}
    assert got == {1.0: (3, 60.0), 2.0: (2, 40.0)}
    rows = sum_up(df, "kjonn", SEX, category=True).collect()
    assert [(r["kjonn"], r["n"]) for r in rows] == [("Mann", 3), ("Kvinne", 2)] or dtype == "double"
    assert {r["kjonn"] for r in rows} == {"Mann", "Kvinne"}


def test_sum_up_details(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "kjonn int")
    assert sorted(r["pct"] for r in sum_up(df, "kjonn", SEX).collect()) == [33.3, 66.7]
    assert sorted(r["pct"] for r in sum_up(df, "kjonn", SEX, digits=0).collect()) == [33.0, 67.0]
    df = spark.createDataFrame([(1,), (9,), (None,), (None,)], "kjonn int")
    rows = sum_up(df, "kjonn", SEX, category=True).collect()
    assert rows[0]["kjonn"] == "Mann" and sum(r["kjonn"] is None for r in rows) == 2
    assert sum(r["n"] for r in rows) == 4
    with pytest.raises(ValueError, match="No value_map found for variable 'age'."):
        sum_up(df, "age", SEX)
    with pytest.raises(TypeError):
        sum_up([1, 2], "kjonn", SEX)
    assert wm.summarise is wm.sum_up and wm.summarize is wm.sum_up and wm.codebook is wm.make_codebook


def test_sum_up_has_no_global_window(spark):
    df = spark.createDataFrame([(1,)], "kjonn int")
    out = sum_up(df, "kjonn", SEX)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "ReusedExchange" in plan


LABELS = Spec.from_dict({
    "yrkesstatus": {"label": "Employed?", "type": "integer", "value": {1: "Ja", 2: "Nei", 8: "x", 9: "y"}},
    "alder": {"label": "Age", "type": "integer"}})


def test_labels_lenient_and_strict(spark):
    df = spark.createDataFrame([("1", 20), ("2", 30), ("D", 40), ("R", None), (None, 1)], "yrkesstatus string, alder int")
    with pytest.warns(UserWarning, match=r"2 value\(s\) converted to NA"):
        out = wm.apply_labels(df, LABELS, strict=False)
    assert dict(out.dtypes)["yrkesstatus"] == "int"
    assert [r[0] for r in out.collect()] == [1, 2, None, None, None]
    assert out.schema["alder"].metadata == {"label": "Age"} and out.schema["yrkesstatus"].metadata["label"] == "Employed?"
    with pytest.raises(ValueError, match="contains values not defined in its value labels: D, R"):
        wm.apply_labels(df, LABELS)
    assert {(r["value"], r["n"]) for r in undeclared_labels(df, LABELS).collect()} == {("D", 1), ("R", 1)}


def test_labels_on_numbers(spark):
    df = spark.createDataFrame([(1.0, 3), (2.0, 4), (float("nan"), 5)], "yrkesstatus double, alder int")
    assert [r[0] for r in wm.apply_labels(df, LABELS).collect()] == [1, 2, None]


def test_string_codes_and_absent_column(spark):
    with pytest.warns(UserWarning):
        spec = Spec.from_dict({"t": {"label": "T", "value": {"s": "spread", "t": "dense"}}, "gone": {"label": "G"}})
    df = spark.createDataFrame([("s",), ("t",), ("s",)], "t string")
    with pytest.warns(UserWarning, match="'gone' not found"):
        out = wm.apply_labels(df, spec)
    assert [r[0] for r in out.collect()] == ["s", "t", "s"]
    book = {r["name"]: r for r in extract_attr(out).collect()}
    assert book["t"]["value_labels"] == "s spread<br>t dense" and book["t"]["label"] == "T"


def test_codebook(spark):
    df = spark.createDataFrame([(1, 20), (2, 30)], "kjonn int, alder int")
    book = {r["name"]: (r["label"], r["value_labels"]) for r in wm.make_codebook(df, SEX).collect()}
    assert book == {"kjonn": ("Sex", "1 Mann<br>2 Kvinne"), "alder": (None, "")}
    with pytest.raises(ValueError, match="no labels"):
        wm.make_codebook(df)
    assert wm.make_codebook(wm.apply_labels(df, SEX)).count() == 2
    counts = {(r["code"], r["label"]): r["n"] for r in codebook_counts(df.union(df), SEX).collect()}
    assert counts == {("1", "Mann"): 2, ("2", "Kvinne"): 2}


def test_metadata_survives_files(spark, tmp_path):
    df = wm.apply_labels(spark.createDataFrame([(1,)], "kjonn int"), SEX)
    df.write.parquet(str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).schema["kjonn"].metadata["label"] == "Sex"


def test_validate(spark, spec):
    df = spark.createDataFrame([(1, None), (9, None), (None, 3)], "kjonn int, alder int")
    assert validate_structure(df).first().asDict() == {"n_rows": 3, "columns": "kjonn, alder"}
    got = {r["variable"]: (r["pct_missing"], r["high"]) for r in missingness(df).collect()}
    assert got == {"kjonn": (33.3, False), "alder": (66.7, True)}
    row = conformance_report(df, spec).first()
    assert (row["variable"], row["unexpected"], row["valid"], row["passed"]) == ("kjonn", ["9"], "1, 2", False)
    done = validate_dataset(df)
    assert done.conformance is None and done.data is df
    assert validate_dataset(df.filter("kjonn = 1"), spec).conformance.first()["passed"]


def test_merge(spark):
    a = spark.createDataFrame([(1, 1.0, True)], "x int, y double, z boolean")
    b = spark.createDataFrame([("D", 2023, 5)], "x string, year int, z int")
    out = merge_datasets([a, b])
    assert out.columns == ["year", "x", "y", "z"]
    assert dict(out.dtypes) == {"year": "int", "x": "string", "y": "double", "z": "int"}
    assert {tuple(r) for r in out.collect()} == {(None, "1", 1.0, 1), (2023, "D", None, 5)}
    assert widest({"double", "int"}) == "double" and widest({"date", "int"}) == "string"


def test_encoding(spark):
    df = spark.createDataFrame([("SmÃ¥ trÃ¸ndersk krÃ¦mmerhus",), ("Ã†rtig",), ("Oslo",), (None,), ("",)], "t string")
    assert [r[0] for r in df.select(fix_double_encoding("t")).collect()] == [
        "Små trøndersk kræmmerhus", "Ærtig", "Oslo", None, ""]
    raw = [b"Sm\xe5 tr\xf8ndersk kr\xe6mmerhus", b"\xc5\xc6\xd8", b"m\xedn", "Små".encode(), "ř".encode(), b"Oslo", None]
    df = spark.createDataFrame([(bytearray(b) if b is not None else None,) for b in raw], "b binary")
    assert [r[0] for r in df.select(fix_bytes("b")).collect()] == [
        "Små trøndersk kræmmerhus", "ÅÆØ", "min", "Små", "ř", "Oslo", None]
    mixed = ["Små ř 漢 \U0001f600 ".encode() + b"Sm\xe5 m\xedn\xed\n" + "í æ".encode(), b"\xc5\xc6" + "Å".encode() + b"\xe5",
             b"\xff\xfe\x80", b"\xc0\xaf", b"\xed\xa0\x80", b"\xf4\x90\x80\x80", b"\xe6\xbc"]
    df = spark.createDataFrame([(bytearray(b),) for b in mixed], "b binary")
    assert [r[0] for r in df.select(fix_bytes("b")).collect()] == [
        "Små ř 漢 \U0001f600 Små mini\ní æ", "ÅÆÅå", "ÿþ\x80", "À¯", "i\xa0\x80", "ô\x90\x80\x80", "æ¼"]
    long = ("Дом ř x\n" * 40_000).encode() + b"\xe5"
    df = spark.createDataFrame([(bytearray(long),)], "b binary")
    assert df.select(fix_bytes("b")).first()[0] == "Дом ř x\n" * 40_000 + "å"
    df = spark.createDataFrame([(bytearray("SmÃ¥ Ã…".encode()),)], "b binary")
    assert df.select(fix_encode("b", "binary", more=True)).first()[0] == "Små Å"


def test_undeclared_codes_are_rows(spark):
    """The table of codes has them all; a report and a text name the first, and how many there are."""
    spec = Spec.from_dict({"k": {"type": "integer", "value": {1: "one"}}})
    df = spark.range(2, 2502).withColumnRenamed("id", "k").union(spark.range(2, 4))
    codes = {r["value"]: r["n"] for r in conformance_codes(df, spec).collect()}
    assert codes == {str(i): 2 if i < 4 else 1 for i in range(2, 2502)}
    row = conformance_report(df, spec).first()
    assert row["unexpected"] == [str(i) for i in range(2, 52)] and (row["n_codes"], row["n_bad"]) == (2500, 2502)
    done = validate_dataset(df, spec)
    assert done.codes.count() == 2500 and not done.conformance.first()["passed"]
    issue = issue_table(profile_cells(df, spec, ["k"]), spec, dict(df.dtypes), ["k"]).first()
    assert issue["n_bad"] == 2502 and ", 51, ... (2500 different codes, all in undeclared_codes). Valid set: 1." in issue["detail"]


def test_strict_labels_name_the_table_of_values(spark):
    spec = Spec.from_dict({"k": {"type": "integer", "value": {1: "one"}}})
    df = spark.range(2, 2502).withColumnRenamed("id", "k").union(spark.range(2, 4))
    with pytest.raises(ValueError, match=r"'k' contains values .*: 10, 100, .*, \.\.\. \(2500 different values in 2502 cells") as error:
        apply_labels(df, spec)
    table = spark.read.parquet(str(error.value).split("all in ")[1].rstrip(")"))
    assert table.count() == 2500 and table.agg({"n": "sum"}).first()[0] == 2502
    with pytest.raises(ValueError) as error:
        apply_labels(df.filter("k < 4"), spec)
    assert str(error.value) == "'k' contains values not defined in its value labels: 2, 3"
