"""The monthly turnover and form 101 as SQL procedures: compound statements run by ``spark.sql`` alone.

Each takes the call date as a parameter, declares its month's bounds, replaces
the month in a partitioned table and answers with one row about it, so that no
result passes through the driver.  They read the views that
``jobs.register_views`` gives SQL users (``ds_<table>``):

    spark.sql(TURNOVER_MONTH.format(mart="dm_account_turnover_f"), args={"on_date": day})
    spark.sql(FORM_101.format(mart="dm_f101_round_f", turnover="dm_account_turnover_f"), args={"on_date": day})

``create_mart`` makes such a table, whose inserts overwrite the partitions they
have rows for, whatever the session's setting.  A body first drops the month's
partitions -- a loop over at most 31 of them -- so that days without rows are
gone as well.  Plain catalog tables have no transaction: a call broken off
between the two is made good by calling again.  The jobs (``kontor.jobs``) write
slice tables, which are switched whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.dates import py_date
from ..specs import spec
from .refresh import MART_SLICES

TURNOVER_MONTH = """
BEGIN
  DECLARE first_day DATE DEFAULT CAST(trunc(:on_date, 'MM') AS DATE);
  DECLARE final_day DATE DEFAULT last_day(:on_date);
  FOR old AS SELECT DISTINCT on_date AS day FROM {mart} WHERE on_date BETWEEN first_day AND final_day DO
    EXECUTE IMMEDIATE 'ALTER TABLE {mart} DROP IF EXISTS PARTITION (on_date = DATE''' || old.day || ''')';
  END FOR;
  INSERT OVERWRITE {mart}
  WITH leg AS (
      SELECT oper_date, account_rk, CAST(sum(coalesce(got, 0)) AS DECIMAL(19,2)) AS got,
             CAST(sum(coalesce(paid, 0)) AS DECIMAL(19,2)) AS paid
      FROM ds_ft_posting_f
      LATERAL VIEW inline(array(
          named_struct('a', credit_account_rk, 'g', CAST(credit_amount AS DECIMAL(18,2)), 'p', CAST(NULL AS DECIMAL(18,2))),
          named_struct('a', debet_account_rk, 'g', CAST(NULL AS DECIMAL(18,2)), 'p', CAST(debet_amount AS DECIMAL(18,2)))))
          side AS account_rk, got, paid
      WHERE oper_date BETWEEN first_day AND final_day
      GROUP BY oper_date, account_rk),
  priced AS (
      SELECT leg.oper_date, leg.account_rk, got, paid, coalesce(rate.reduced_cource, 1) AS price
      FROM leg
      JOIN ds_md_account_d AS held ON held.account_rk = leg.account_rk
           AND trunc(held.data_actual_date, 'MM') = trunc(leg.oper_date, 'MM')
           AND leg.oper_date BETWEEN held.data_actual_date AND held.data_actual_end_date
      LEFT JOIN ds_md_exchange_rate_d AS rate ON rate.currency_rk = held.currency_rk
           AND leg.oper_date BETWEEN rate.data_actual_date AND rate.data_actual_end_date)
  SELECT account_rk, CAST(sum(got) AS DECIMAL(23,8)), CAST(sum(got * price) AS DECIMAL(23,8)),
         CAST(sum(paid) AS DECIMAL(23,8)), CAST(sum(paid * price) AS DECIMAL(23,8)), oper_date
  FROM priced GROUP BY oper_date, account_rk;
  SELECT first_day AS from_date, final_day AS to_date, count(*) AS rows
  FROM {mart} WHERE on_date BETWEEN first_day AND final_day;
END"""


FORM_101 = """
BEGIN
  DECLARE first_day DATE DEFAULT CAST(trunc(:on_date, 'MM') AS DATE);
  DECLARE final_day DATE DEFAULT last_day(:on_date);
  DECLARE called DATE DEFAULT CAST(:on_date AS DATE);
  EXECUTE IMMEDIATE 'ALTER TABLE {mart} DROP IF EXISTS PARTITION (from_date = DATE''' || first_day || ''')';
  INSERT OVERWRITE {mart}
  WITH turned AS (
      SELECT account_rk, count(*) AS days, sum(coalesce(debet_amount_rub, 0)) AS deb,
             sum(coalesce(credit_amount_rub, 0)) AS cre
      FROM {turnover} WHERE on_date BETWEEN first_day AND final_day GROUP BY account_rk),
  chart AS (
      SELECT chapter, CAST(ledger_account AS STRING) AS ledger_account
      FROM ds_md_ledger_account_s WHERE called BETWEEN start_date AND end_date),
  money AS (
      SELECT c.currency_rk, c.currency_code IN ('643', '810') AS domestic, r.reduced_cource AS price
      FROM ds_md_currency_d AS c
      LEFT JOIN ds_md_exchange_rate_d AS r ON r.currency_rk = c.currency_rk
           AND called BETWEEN r.data_actual_date AND r.data_actual_end_date
      WHERE called BETWEEN c.data_actual_date AND c.data_actual_end_date),
  line AS (
      SELECT chart.chapter, chart.ledger_account, a.char_type AS kind, domestic,
             CAST(b.balance_out * greatest(coalesce(days, 1), 1) AS DECIMAL(18,2))
                 * CASE WHEN domestic THEN CAST(1 AS DECIMAL(18,8)) ELSE price END AS opened,
             coalesce(deb, 0) AS deb, coalesce(cre, 0) AS cre
      FROM ds_md_account_d AS a
      JOIN chart ON chart.ledger_account = substring(a.account_number, 1, 5)
      JOIN money ON money.currency_rk = a.currency_rk
      LEFT JOIN ds_ft_balance_f AS b ON b.account_rk = a.account_rk AND b.on_date = date_sub(first_day, 1)
      LEFT JOIN turned ON turned.account_rk = a.account_rk
      WHERE called BETWEEN a.data_actual_date AND a.data_actual_end_date),
  summed AS (
      SELECT chapter, ledger_account, kind,
             CAST(sum(CASE WHEN domestic THEN opened ELSE 0 END) AS DECIMAL(25,10)) AS in_rub,
             CAST(sum(CASE WHEN domestic THEN 0 ELSE opened END) AS DECIMAL(25,10)) AS in_val,
             CAST(sum(opened) AS DECIMAL(25,10)) AS in_total,
             sum(deb) FILTER (WHERE domestic) AS deb_rub, sum(deb) FILTER (WHERE NOT domestic) AS deb_val,
             sum(deb) AS deb_total,
             sum(cre) FILTER (WHERE domestic) AS cre_rub, sum(cre) FILTER (WHERE NOT domestic) AS cre_val,
             sum(cre) AS cre_total
      FROM line GROUP BY chapter, ledger_account, kind),
  filled AS (
      SELECT *, CAST(coalesce(deb_rub, 0) AS DECIMAL(25,8)) AS dr, CAST(coalesce(deb_val, 0) AS DECIMAL(25,8)) AS dv,
             CAST(coalesce(cre_rub, 0) AS DECIMAL(25,8)) AS cr, CAST(coalesce(cre_val, 0) AS DECIMAL(25,8)) AS cv
      FROM summed),
  closed AS (
      SELECT *, in_rub + CASE kind WHEN 'A' THEN dr - cr WHEN 'P' THEN cr - dr END AS out_rub,
             in_val + CASE kind WHEN 'A' THEN dv - cv WHEN 'P' THEN cv - dv END AS out_val FROM filled)
  SELECT {columns} FROM closed;
  SELECT first_day AS from_date, final_day AS to_date, count(*) AS rows FROM {mart} WHERE from_date = first_day;
END"""

# Where each measure of the form comes from; the others of its columns have no rule and are NULL.
_MEASURES = {"balance_in": ("in_rub", "in_val", "in_total"), "turn_deb": ("dr", "dv", "deb_total"),
             "turn_cre": ("cr", "cv", "cre_total"), "balance_out": ("out_rub", "out_val", "out_rub + out_val")}


def _form_columns() -> str:
    values = {"to_date": "final_day", "chapter": "chapter", "ledger_account": "ledger_account", "characteristic": "kind",
              "from_date": "first_day"}
    for measure, sources in _MEASURES.items():
        values |= {f"{measure}_{part}": f"CAST({s} AS DECIMAL(23,8))" for part, s in zip(("rub", "val", "total"), sources)}
    s = spec("dm_f101_round_f")
    order = [c for c in s.columns if c != "from_date"] + ["from_date"]
    return ", ".join(values.get(c, f"CAST(NULL AS {s.schema[c].dataType.simpleString()})") for c in order)


def create_mart(spark: SparkSession, table: str, name: str, path: str) -> None:
    """An empty mart ``name`` (see ``specs``) as catalog table ``table``, partitioned by its date, under ``path``."""
    column = MART_SLICES[name]
    fields = [f for f in spec(name).schema.fields if f.name != column] + [spec(name).schema[column]]
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
              f"OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY ({column}) LOCATION '{path}'")


def fill_turnover(spark: SparkSession, table: str, on_date) -> DataFrame:
    """One call of the turnover procedure: (from_date, to_date, rows)."""
    return spark.sql(TURNOVER_MONTH.format(mart=table), args={"on_date": py_date(on_date)})


def fill_form_101(spark: SparkSession, table: str, turnover: str, on_date) -> DataFrame:
    """One call of the form-101 procedure: (from_date, to_date, rows)."""
    return spark.sql(FORM_101.format(mart=table, turnover=turnover, columns=_form_columns()),
                     args={"on_date": py_date(on_date)})
