"""A key holding a third of all rows: results stay whole and the plan
reduces the hot key map-side, before any shuffle."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from kontor.operators import deltas as DL
from kontor.plans import turnover as TO

ACC = "data_actual_date date, data_actual_end_date date, account_rk bigint, account_number string, " \
      "char_type string, currency_rk bigint, currency_code string"
RATE = "data_actual_date date, data_actual_end_date date, currency_rk bigint, reduced_cource decimal(18,8), " \
       "code_iso_num string"


def _postings(spark, n=30000):
    # every third posting credits the hot account 1; the rest spread over 1000 accounts
    return spark.range(n).select(
        F.date_add(F.lit(dt.date(2018, 1, 1)), (F.col("id") % 28).cast("int")).alias("oper_date"),
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 1000 + 2).cast("long").alias("credit_account_rk"),
        (F.col("id") % 997 + 5000).cast("long").alias("debet_account_rk"),
        F.lit(D("1.25")).cast("decimal(18,2)").alias("credit_amount"),
        F.lit(D("1.25")).cast("decimal(18,2)").alias("debet_amount"),
    )


def test_hot_account_turnover_is_whole(spark):
    p = _postings(spark)
    accts = spark.range(1, 7000).select(
        F.lit(dt.date(2018, 1, 1)).alias("data_actual_date"), F.lit(dt.date(2018, 1, 31)).alias("data_actual_end_date"),
        F.col("id").alias("account_rk"), F.lit("30101").alias("account_number"), F.lit("A").alias("char_type"),
        F.lit(1).cast("long").alias("currency_rk"), F.lit("643").alias("currency_code"))
    rates = spark.createDataFrame([], RATE)
    out = TO.turnover_month(p, accts, rates, "2018-01-15")
    hot = out.filter("account_rk = 1").agg(F.sum("credit_amount").alias("s"), F.count("*").alias("days")).first()
    assert hot["s"] == D("12500.00000000")  # 10000 postings of 1.25, none dropped
    assert hot["days"] == 28
    plan = out._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.find("Exchange hashpartitioning")
    assert shuffle >= 0
    assert "partial_sum" in plan[shuffle:]  # the hot key is summed map-side, below the shuffle


def test_hot_key_delta_fold(spark):
    deltas = spark.range(6000).select(
        (F.col("id") % 30 + 1000).cast("int").alias("delta_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).cast("long").alias("k"),
        F.col("id").cast("string").alias("v"),
    ).dropDuplicates(["delta_id", "k"])
    mirror = spark.createDataFrame([], "k bigint, v string")
    out = DL.apply_deltas(mirror, deltas, ["k"])
    last_hot = deltas.filter("k = 7").orderBy(F.desc("delta_id")).first()["v"]
    assert out.filter("k = 7").collect()[0]["v"] == last_hot
    assert out.count() == deltas.select("k").distinct().count()
