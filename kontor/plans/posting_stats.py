"""Max/min posting amounts per date, and the date-parameterised table
function over postings.

The source function returns nothing for a date without postings (an
``IN (subquery)`` guard).  Grouping an empty filter already yields no
rows, so the guard is redundant; ``posting_minmax_guarded`` keeps it as
a left-semi join (what Catalyst makes of ``IN (subquery)``) for fidelity.
Both the guarded form and the SQL table function take many dates at
once (a frame of dates, or a LATERAL call), so a whole calendar is one job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import as_date, py_date

# Fixed value: the name that users of the source call the table function by.
FUNCTION = "func_ds_ft_posting_f"


def posting_minmax(postings: DataFrame) -> DataFrame:
    """For every posting date: max and min credit and debit amounts."""
    return postings.groupBy(F.col("oper_date").alias("oper_dates")).agg(
        F.max("credit_amount").alias("max_credit_amount"),
        F.min("credit_amount").alias("min_credit_amount"),
        F.max("debet_amount").alias("max_debet_amount"),
        F.min("debet_amount").alias("min_debet_amount"),
    )


def _requested(postings: DataFrame, on_dates) -> DataFrame:
    """Requested dates as a one-column frame ``oper_date``."""
    if isinstance(on_dates, DataFrame):
        return on_dates.select(F.col(on_dates.columns[0]).cast("date").alias("oper_date"))
    return postings.sparkSession.range(1).select(as_date(on_dates).alias("oper_date"))


def posting_minmax_guarded(postings: DataFrame, on_dates) -> DataFrame:
    """Min/max for each requested date (one date or a frame of dates) that
    occurs in postings -- the source's ``IF d IN (SELECT oper_date ...)``
    guard as a left-semi join; a requested date without postings gives no row."""
    wanted = _requested(postings, on_dates)
    # the posting dates collapse map-side: a few rows per task are shuffled, not the postings
    present = wanted.join(postings.select("oper_date").distinct(), "oper_date", "left_semi")
    return posting_minmax(postings.join(present, "oper_date", "left_semi"))


def day_spine(postings: DataFrame) -> DataFrame:
    """Every calendar day from the first to the last posting date (column ``day``)."""
    return postings.agg(F.min("oper_date").alias("lo"), F.max("oper_date").alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("day"))


def register_posting_function(spark: SparkSession, postings_view: str,
                              name: str = FUNCTION) -> str:
    """CREATE TEMPORARY FUNCTION name(d DATE) RETURNS TABLE(...) over a view.

    A SQL table function: ``SELECT * FROM name(DATE '2018-01-10')``.
    The parameter may only appear in WHERE; the date column is projected
    from the grouping key.
    """
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(i_on_date DATE)
        RETURNS TABLE (oper_dates DATE, max_credit_amount DECIMAL(18,2),
                       min_credit_amount DECIMAL(18,2), max_debet_amount DECIMAL(18,2),
                       min_debet_amount DECIMAL(18,2))
        RETURN SELECT oper_date, max(credit_amount), min(credit_amount),
                      max(debet_amount), min(debet_amount)
               FROM {postings_view}
               WHERE oper_date = i_on_date
               GROUP BY oper_date""")
    return name


def call_posting_function_over(spark: SparkSession, postings: DataFrame, days: DataFrame,
                               view: str = "ds_ft_posting_f", name: str = FUNCTION) -> DataFrame:
    """The table function called once per requested day, as a LATERAL call;
    Catalyst decorrelates it into one grouped aggregation and a join."""
    postings.createOrReplaceTempView(view)
    days.select(F.col(days.columns[0]).cast("date").alias("day")).createOrReplaceTempView(f"{view}_days")
    register_posting_function(spark, view, name)
    return spark.sql(f"SELECT f.* FROM {view}_days d, LATERAL {name}(d.day) f")


def call_posting_function(spark: SparkSession, postings: DataFrame, on_date,
                          view: str = "ds_ft_posting_f", name: str = FUNCTION) -> DataFrame:
    postings.createOrReplaceTempView(view)
    register_posting_function(spark, view, name)
    return spark.sql(f"SELECT * FROM {name}(:d)", args={"d": py_date(on_date)})
