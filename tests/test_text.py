import pytest
from pyspark.sql import functions as F

from entwine.functions import text as T


def values(spark, f, items):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], "i int, x string")
    return [r.y for r in df.select("i", f(F.col("x")).alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize(
    ("f", "pairs"),
    [
        (T.name, {"Müller & Söhne  GmbH": "muller and sohne gmbh", "Tick@Tock": "tick at tock", "O’Neill – Boats_2": "o neill boats_2", "R&amp;D": "r and d", None: "", "  ": ""}),
        (T.without_suffix, {"harbour kite works pty ltd": "harbour kite works", "limited editions limited": "limited editions", "gmbh": "gmbh", "sa sa": "sa", "coast": "coast", "pinco": "pinco", "moss inc": "moss"}),
        (T.postal_code, {"Dock 4, 90210-4433 and 12345": "90210", "near 400076, not 90210": "400076", "1234567": "", "Quay 9": "", None: ""}),
        (T.country, {"Deutschland": "GERMANY", " gb ": "UNITED KINGDOM", "French Republic": "FRANCE", "U.S.": "US", "Peru": "PERU", "": "UNKNOWN", None: "UNKNOWN"}),
        (T.address, {"9 N Elm Blvd, Fl 2": "9 north elm boulevard floor 2", "Hwy 7 SE": "highway 7 southeast", "Stanley Wharf": "stanley wharf", None: ""}),
        (T.digit_runs, {"4b 17 a 0090": "17 0090", "x": "", None: ""}),
    ],
)
def test_normalisation(spark, f, pairs):
    assert values(spark, f, list(pairs)) == list(pairs.values())
