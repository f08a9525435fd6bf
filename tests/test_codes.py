import pytest
from pyspark.sql import functions as F

from wavemeld.functions import cells as C
from wavemeld.spec import Variable

TEXTS = ["0", "1", "-7", "18", "007", "1.5", "x", "TRUE", "3000000000", ""]
COLUMNS = {
    "int": [0, 1, -7, 18, 7, None], "bigint": [0, 1, 3000000000, None],
    "double": [0.0, -0.0, 1.0, 1.5, -7.0, 18.25, float("nan"), float("inf"), 3e9, None],
    "float": [0.0, 1.5, -7.0, None], "string": ["0", "007", "1.50", "x", "", None], "boolean": [True, False, None],
    "decimal(6,2)": None, "date": None,
}


@pytest.mark.parametrize("dtype", list(COLUMNS))
@pytest.mark.parametrize("texts", [TEXTS, ["1", "18"], []])
def test_typed_comparison_is_the_text_comparison(spark, dtype, texts):
    if COLUMNS[dtype] is None:
        df = spark.sql(f"select cast(v as {dtype}) c from values ('1.50'), ('2020-01-01'), ('7') t(v) "
                       f"where try_cast(v as {dtype}) is not null")
    else:
        df = spark.createDataFrame([(v,) for v in COLUMNS[dtype]], f"c {dtype}")
    cell = F.col("c")
    by_text = F.when(~C.is_missing(cell, dtype), C.string_form(cell, dtype).isin(*texts))
    rows = df.select(C.equals_any(cell, dtype, texts).alias("got"), by_text.alias("want"), "c").collect()
    for r in rows:
        assert r["got"] == r["want"], r
    var = Variable("v", recodes=tuple((t, 5) for t in texts))
    if dtype != "boolean" and dtype != "date":
        for r in df.select(C.recode(cell, dtype, var).alias("got"), by_text.alias("hit"), "c").collect():
            want = ("5" if dtype == "string" else 5) if r["hit"] else r["c"]
            assert r["got"] == want or (r["got"] != r["got"] and r["c"] != r["c"])
