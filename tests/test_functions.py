import datetime as dt

from pyspark.sql import functions as F

from kontor.functions import dates as D
from kontor.functions import text as X


def test_month_bounds_and_parsing(spark):
    row = spark.range(1).select(
        D.month_start("1998-03-17").alias("ms"), D.month_end("2000-02-10").alias("me"),
        D.prev_month_end("1998-03-17").alias("pe"), D.iso("1998-03-17").alias("iso"),
        D.parse_dotted(F.lit("31.12.2017")).alias("p"), D.parse_iso(F.lit("2018-13-01")).alias("bad"),
    ).first()
    assert row["ms"] == dt.date(1998, 3, 1) and row["me"] == dt.date(2000, 2, 29)
    assert row["pe"] == dt.date(1998, 2, 28) and row["iso"] == "1998-03-17"
    assert row["p"] == dt.date(2017, 12, 31) and row["bad"] is None
    assert D.month_bounds("2018-02-10") == (dt.date(2018, 2, 1), dt.date(2018, 2, 28))


def test_key_list_and_capitalise(spark):
    assert X.normalise_key_list(" data_actual_date , account_rk") == ["DATA_ACTUAL_DATE", "ACCOUNT_RK"]
    row = spark.range(1).select(X.capitalise(F.lit("ice hockey")).alias("c"),
                                X.strip_quotes(F.lit("it's")).alias("q")).first()
    assert row["c"] == "Ice Hockey" and row["q"] == "its"
