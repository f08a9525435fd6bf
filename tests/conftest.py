import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    shared = tempfile.mkdtemp(prefix="shared-")
    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
               .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g")
               .config("spark.checkpoint.dir", shared).getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def spec():
    from wavemeld.spec import Spec
    return Spec.from_dict(VAR_MAP)


# A small survey: sex and age by different names, one text cell in an integer
# column, undeclared codes, missing codes.
VAR_MAP = {
    "kjonn": {"colnames": ["Kjonn"], "keywords": ["kjonn", "sex", "gender"], "type": "integer",
              "label": "Respondent's sex", "value": {1: "Mann", 2: "Kvinne"},
              "recode": {"0": 2, "1": 1, "2": 2}, "missing": ["NA"]},
    "alder": {"colnames": ["Alder"], "keywords": ["alder", "age", "ageyrs"], "type": "integer",
              "label": "Respondent's age", "missing": ["NA"]},
    "yrkesstatus": {"colnames": ["Yrkesstatus"], "keywords": ["yrkesstatus"], "type": "integer", "label": "Employed?",
                    "value": {1: "Ja", 2: "Nei", 8: "ikke svar", 9: "vet ikke"}, "missing": [8, 9]},
    "siv": {"colnames": ["Siv"], "keywords": ["siv"], "type": "integer", "label": "Civil status",
            "value": {1: "gift", 2: "samboer", 3: "Nei"}, "missing": [8, 9]},
    "antpers": {"colnames": ["Antpers"], "keywords": ["antpers"], "type": "integer", "label": "Household size",
                "missing": ["NA", 99]},
    "tob1": {"colnames": ["Tob1"], "keywords": ["tob1"], "type": "integer", "label": "Smokes",
             "value": {1: "Ja", 2: "Nei"}, "missing": None},
}

SURVEY_HEADER = ["IO_Kjonn", "Alder", "Yrkesstatus", "Siv", "Antpers", "Tob1"]
SURVEY_ROWS = [
    (2, 71, 2, "3", 1, 2), (2, 44, 1, "1", 2, 2), (1, 31, 1, "3", 1, 9), (1, 36, 1, "2", 5, 2),
    (2, 52, 1, "1", 3, 2), (1, 39, 8, "1", 98, 8), (2, 66, 9, "D", 99, 1), (2, 58, 1, "2", 4, 2),
]


@pytest.fixture()
def survey(spark):
    return spark.createDataFrame(
        SURVEY_ROWS, "IO_Kjonn int, Alder int, Yrkesstatus int, Siv string, Antpers int, Tob1 int")
