import pytest

from wavemeld.spec import (Spec, alias_table, keyword_table, label_table, load_config, missing_table, recode_table,
                           type_table, value_table, whole_number)

TEXT = """
kjonn:
  colnames: [Kjonn, IO_Kjonn]
  keywords: [kjonn, " Sex ", NA, ab, "a.b+c"]
  type: integer
  label: "Respondentens kjønn"
  value: {1: Mann, 2: Kvinne}
  recode: {"0": 2, "x": y}
  missing: [NA, 99]
alder:
  colnames: [Alder, kjonn]
town:
  value: {s: spread, t: dense}
  recode: ~
  missing:
"""


@pytest.fixture()
def config(tmp_path):
    path = tmp_path / "map.yml"
    path.write_text(TEXT, encoding="utf-8")
    with pytest.warns(UserWarning, match="codes of"):
        return load_config(path)


def test_missing_file():
    with pytest.raises(FileNotFoundError, match="not found"):
        load_config("no/such/file.yml")


def test_lookups(config):
    assert config.names == ["kjonn", "alder", "town"]
    assert config.aliases == [(0, "Kjonn", "kjonn"), (1, "IO_Kjonn", "kjonn"), (2, "kjonn", "kjonn"),
                              (3, "io_kjonn", "kjonn"), (4, "Alder", "alder"), (5, "alder", "alder")]
    k = config["kjonn"]
    assert k.label == "Respondentens kjønn" and k.type == "integer" and config["alder"].type == "character"
    assert k.codes == ("1", "2") and k.code_type == "integer" and k.missing_integers == (99,)
    assert k.recodes == (("0", 2), ("x", None))
    assert config["town"].code_type == "character" and config["town"].codes == ("s", "t")
    assert config["town"].valid_integers == () and config["town"].missing is None
    assert config["alder"].pattern is None and config["alder"].values is None


def test_keyword_pattern(config):
    assert config["kjonn"].pattern == r"(?<![a-z0-9])(kjonn|sex|a\.b\+c)(?![a-z0-9])"


@pytest.mark.parametrize("value,want", [("1", 1), ("1.7", 1), (3, 3), (2.9, 2), ("x", None), (None, None), ("1e3", 1000),
                                        ("99999999999", None)])
def test_whole_number(value, want):
    assert whole_number(value) == want


def test_tables_agree_with_the_driver(spark, config):
    d = config.definitions(spark)
    rows = sorted((r["ord"], r["pos"], r["alias"], r["canonical"]) for r in alias_table(d).collect())
    assert [(a, c) for _, _, a, c in rows] == [(a, c) for _, a, c in config.aliases]
    assert {r["canonical"]: r["type"] for r in type_table(d).collect()} == {v.name: v.type for v in config.variables}
    assert {r["canonical"]: r["label"] for r in label_table(d).collect()} == {v.name: v.label for v in config.variables}
    assert {(r["canonical"], r["code"], r["code_type"]) for r in value_table(d).collect()} == {
        (v.name, c, v.code_type) for v in config.variables if v.values for c in v.codes}
    assert {(r["canonical"], r["raw_value"], r["new_value"]) for r in recode_table(d).collect()} == {
        ("kjonn", "0", 2), ("kjonn", "x", None)}
    assert [(r["canonical"], r["code"]) for r in missing_table(d).collect()] == [("kjonn", 99)]
    assert {r["canonical"]: r["pattern"] for r in keyword_table(d).collect()} == dict(config.patterns)


def test_spec_tables_broadcast_by_size(spark, config):
    df = spark.range(10).selectExpr("cast(id as string) alias")
    plan = df.join(config.alias_frame(spark), "alias")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_map_kept_as_a_table(spark, config):
    with pytest.warns(UserWarning, match="codes of"):
        back = load_config(config.definitions(spark))
    assert back == config


def test_codes_of_a_map_kept_as_a_table_are_a_table(spark, config):
    """The value table is made by Spark: nothing of the map visits the driver for it, however odd its rows are."""
    with pytest.warns(UserWarning, match="codes of"):
        back = load_config(config.definitions(spark))
    want = {tuple(r) for r in config.value_frame(spark).collect()}
    assert {tuple(r) for r in back.value_frame(spark).collect()} == want
    assert "variables" not in vars(back)
    pairs = "array<struct<key:string,value:string>>"
    odd = spark.createDataFrame([
        (1, "a", [("1", "one"), ("2", "two"), ("1", "uno")]), (2, "b", [(None, "nothing"), ("7", None)]),
        (3, "a", [("9", "nine"), ("9.0", "also")]), (None, None, [("4", "four")]), (5, "c", None), (6, "d", []),
        (7, "e", [("1", "one"), ("2", "two"), ("1", "uno")])],
        f"ord int, canonical string, values {pairs}").selectExpr(
        "*", "array(canonical) aliases", "array(canonical) keywords", "'integer' type", "canonical label",
        f"cast(array() as {pairs}) recodes", "array('9') missing")
    with pytest.warns(UserWarning, match="codes of `b`"):
        back = load_config(odd)
    found = {tuple(r) for r in back.value_frame(spark).collect()}
    assert found == {("a", 0, "9", "nine"), ("a", 1, "9", "also"), ("b", 0, "None", "nothing"), ("b", 1, "7", "None"),
                     ("None", 0, "4", "four"), ("e", 0, "1", "uno"), ("e", 1, "2", "two")}
    assert {tuple(r) for r in Spec(back.variables).value_frame(spark).collect()} == found
    assert {r["code"] for r in back.value_frame(spark, "e").collect()} == {"1", "2"}
