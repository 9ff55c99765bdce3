"""Independent SQL statements (DuckDB dialect) for the correctness gate.

The driver registers the raw tables (lineitem, orders, ...) as views;
``with_views`` prepends the derived ledger tables of
``kontor.sources.testbed`` as CTEs, written here a second time in SQL so
the Spark code is checked against an independent formulation.
"""

from __future__ import annotations

# Shared fixed values: see kontor.sources.testbed.
_CODE = """CASE WHEN {rk} % 10 = 0 THEN '643' WHEN {rk} % 10 = 5 THEN '810'
            ELSE lpad(CAST({rk} AS VARCHAR), 3, '0') END"""

VIEW_SQL: dict[str, str] = {
    "raw_posting": """
        SELECT CAST(o.o_orderdate AS DATE) AS oper_date,
               1000000000000 + l.l_suppkey AS credit_account_rk,
               o.o_custkey AS debet_account_rk,
               CAST(l.l_extendedprice AS DECIMAL(18,2)) AS credit_amount,
               CAST(l.l_extendedprice AS DECIMAL(18,2)) AS debet_amount
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "ft_posting_f": """
        SELECT oper_date, credit_account_rk, debet_account_rk,
               CAST(SUM(credit_amount) AS DECIMAL(18,2)) AS credit_amount,
               CAST(SUM(debet_amount) AS DECIMAL(18,2)) AS debet_amount
        FROM raw_posting
        WHERE oper_date IS NOT NULL AND credit_account_rk IS NOT NULL AND debet_account_rk IS NOT NULL
        GROUP BY oper_date, credit_account_rk, debet_account_rk""",
    "account_base": """
        SELECT c_custkey AS account_rk, CAST(c_nationkey AS BIGINT) AS currency_rk,
               CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'A' ELSE 'P' END AS char_type,
               CAST(c_acctbal AS DECIMAL(18,2)) AS acctbal
        FROM customer
        UNION ALL
        SELECT 1000000000000 + s_suppkey, CAST(s_nationkey AS BIGINT),
               CASE WHEN s_suppkey % 2 = 0 THEN 'A' ELSE 'P' END,
               CAST(s_acctbal AS DECIMAL(18,2))
        FROM supplier""",
    "account_span": """
        SELECT account_rk, min(oper_date) AS lo, max(oper_date) AS hi
        FROM (SELECT credit_account_rk AS account_rk, oper_date FROM ft_posting_f
              UNION ALL
              SELECT debet_account_rk, oper_date FROM ft_posting_f) legs
        GROUP BY account_rk""",
    "account_version": """
        SELECT b.account_rk, b.currency_rk, b.char_type, b.acctbal,
               CAST(g.m AS DATE) AS data_actual_date
        FROM account_base b
        JOIN account_span s ON s.account_rk = b.account_rk,
        LATERAL (SELECT unnest(generate_series(CAST(date_trunc('month', s.lo) AS DATE),
                                               CAST(date_trunc('month', s.hi) AS DATE),
                                               INTERVAL 1 MONTH)) AS m) g""",
    "md_account_d": f"""
        SELECT data_actual_date, last_day(data_actual_date) AS data_actual_end_date, account_rk,
               CAST(30100 + currency_rk % 7 AS VARCHAR) || lpad(CAST(account_rk AS VARCHAR), 15, '0')
                   AS account_number,
               char_type, currency_rk, {_CODE.format(rk='currency_rk')} AS currency_code
        FROM account_version""",
    "ft_balance_f": """
        SELECT CAST(data_actual_date - INTERVAL 1 DAY AS DATE) AS on_date, account_rk, currency_rk,
               acctbal AS balance_out
        FROM account_version
        WHERE account_rk % 17 <> 3""",
    "md_currency_d": f"""
        SELECT CAST(n_nationkey AS BIGINT) AS currency_rk,
               DATE '1900-01-01' AS data_actual_date, DATE '2999-12-31' AS data_actual_end_date,
               {_CODE.format(rk='n_nationkey')} AS currency_code,
               CASE WHEN ({_CODE.format(rk='n_nationkey')}) IN ('643', '810') THEN 'RUB'
                    ELSE 'C' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') END AS code_iso_char
        FROM nation""",
    "rate_month": """
        SELECT c.currency_rk, c.currency_code, CAST(g.m AS DATE) AS data_actual_date
        FROM md_currency_d c
        JOIN (SELECT currency_rk, min(data_actual_date) AS lo, max(data_actual_date) AS hi
              FROM md_account_d GROUP BY currency_rk) s ON s.currency_rk = c.currency_rk,
        LATERAL (SELECT unnest(generate_series(s.lo, s.hi, INTERVAL 1 MONTH)) AS m) g
        WHERE c.currency_code NOT IN ('643', '810')""",
    "md_exchange_rate_d": """
        SELECT data_actual_date, last_day(data_actual_date) AS data_actual_end_date, currency_rk,
               CAST(CAST((currency_rk + 1) * 100000000
                         + ((year(data_actual_date) * 12 + month(data_actual_date)) * 7919
                            + currency_rk * 104729) % 100000000 AS DECIMAL(18,0))
                    * CAST(0.00000001 AS DECIMAL(9,8)) AS DECIMAL(18,8)) AS reduced_cource,
               currency_code AS code_iso_num
        FROM rate_month
        WHERE (month(data_actual_date) + currency_rk) % 11 <> 0""",
    "md_ledger_account_s": """
        SELECT CASE WHEN ledger_account % 2 = 0 THEN 'A' ELSE 'B' END AS chapter,
               'Chapter ' || CASE WHEN ledger_account % 2 = 0 THEN 'A' ELSE 'B' END AS chapter_name,
               CAST(ledger_account % 10 + 1 AS INTEGER) AS section_number,
               ledger_account,
               'Ledger ' || CAST(ledger_account AS VARCHAR) AS ledger_account_name,
               CASE WHEN ledger_account % 2 = 0 THEN 'A' ELSE 'P' END AS characteristic,
               DATE '1900-01-01' AS start_date, DATE '2999-12-31' AS end_date
        FROM (SELECT DISTINCT CAST(30100 + n_nationkey % 7 AS INTEGER) AS ledger_account FROM nation) n""",
    "deltas": """
        SELECT CAST(strftime(CAST(ts AS DATE), '%Y%m%d') AS INTEGER) AS delta_id,
               user_id AS account_rk, CAST(ts AS DATE) AS data_actual_date, event_type,
               CAST(value AS DECIMAL(18,2)) AS amount
        FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC) = 1""",
}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with every derived view as a CTE (unused ones cost nothing)."""
    ctes = ",\n".join(f"{name} AS ({body})" for name, body in VIEW_SQL.items())
    body = sql.strip()
    if body[:4].upper() == "WITH" and body[4:5].isspace():
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def _turnover_sql(start: str | None, end: str | None) -> str:
    """Both sides of each posting as legs, each leg priced by one join, then summed."""
    days = f"WHERE oper_date BETWEEN DATE '{start}' AND DATE '{end}'" if start else ""
    return f"""
    leg AS (
        SELECT oper_date AS day, credit_account_rk AS acct, credit_amount AS got, NULL AS paid FROM ft_posting_f {days}
        UNION ALL
        SELECT oper_date, debet_account_rk, NULL, debet_amount FROM ft_posting_f {days}),
    priced AS (
        SELECT day, acct, coalesce(got, 0) AS got, coalesce(paid, 0) AS paid, coalesce(fx.reduced_cource, 1) AS price
        FROM leg
        JOIN md_account_d v ON v.account_rk = acct AND day BETWEEN v.data_actual_date AND v.data_actual_end_date
             AND date_trunc('month', v.data_actual_date) = date_trunc('month', day)
        LEFT JOIN md_exchange_rate_d fx ON fx.currency_rk = v.currency_rk
             AND day BETWEEN fx.data_actual_date AND fx.data_actual_end_date)
    SELECT day AS on_date, acct AS account_rk,
           CAST(sum(got) AS DECIMAL(23,8)) AS credit_amount, CAST(sum(got * price) AS DECIMAL(23,8)) AS credit_amount_rub,
           CAST(sum(paid) AS DECIMAL(23,8)) AS debet_amount, CAST(sum(paid * price) AS DECIMAL(23,8)) AS debet_amount_rub
    FROM priced GROUP BY day, acct"""


def turnover_cte(start: str | None, end: str | None) -> str:
    """The turnover mart as a named CTE body ``dm_account_turnover_f``."""
    steps, result = _turnover_sql(start, end).split("    SELECT day AS on_date", 1)
    return steps.rstrip() + ",\n    dm_account_turnover_f AS (SELECT day AS on_date" + result + ")"


CALL_DATE = "1998-03-03"
MONTH_START, MONTH_END = "1998-03-01", "1998-03-31"

ORACLE: dict[str, str] = {
    "posting_collapse": with_views("SELECT * FROM ft_posting_f"),
    "turnover_day": with_views("WITH" + _turnover_sql(CALL_DATE, CALL_DATE)),
    "turnover_month": with_views("WITH" + _turnover_sql(MONTH_START, MONTH_END)),
    "turnover_all": with_views("WITH" + _turnover_sql(None, None)),
}


# One row per report: its month, the last day, the call date and the day of the opening balance.
_ONE_REPORT = f"""
    report AS (SELECT DATE '{MONTH_START}' AS m, DATE '{MONTH_END}' AS till, DATE '{CALL_DATE}' AS called,
                      DATE '1998-02-28' AS eve)"""
_EVERY_REPORT = """
    report AS (SELECT CAST(g.m AS DATE) AS m, last_day(CAST(g.m AS DATE)) AS till, last_day(CAST(g.m AS DATE)) AS called,
                      CAST(g.m - INTERVAL 1 DAY AS DATE) AS eve
               FROM (SELECT date_trunc('month', min(oper_date)) AS lo, max(oper_date) AS hi FROM ft_posting_f) r,
               LATERAL (SELECT unnest(generate_series(CAST(r.lo AS DATE), r.hi, INTERVAL 1 MONTH)) AS m) g)"""


def _f101_sql(fan_out: bool) -> str:
    """Form 101 per account first: what it opened with, what it turned over and on how many days, and the version
    and price it is reported under; one line per account, then summed by kind of currency."""
    weight = "greatest(coalesce(turned.days, 1), 1)" if fan_out else "1"

    def by_kind(measure: str, empty: str) -> str:
        one = "coalesce(sum({m}) FILTER (WHERE kind = '{k}'), {e})"
        parts = [one.format(m=measure, k=k, e=empty.format(k=k)) + f" AS {measure}_{k}" for k in ("rub", "val")]
        return ",\n               ".join([*parts, f"sum({measure}) AS {measure}_total"])

    none_of_it = "CASE WHEN count(*) FILTER (WHERE kind <> '{k}') > 0 THEN 0 END"
    closing = []
    for k in ("rub", "val"):
        closing.append(f"""balance_in_{k} + CASE characteristic WHEN 'A' THEN turn_deb_{k} - turn_cre_{k}
                                          WHEN 'P' THEN turn_cre_{k} - turn_deb_{k} END AS balance_out_{k}""")
    measures = [f"{m}_{k}" for m in ("balance_in", "turn_deb", "turn_cre", "balance_out") for k in ("rub", "val", "total")]
    columns = ",\n           ".join(f"CAST({m} AS DECIMAL(23,8)) AS {m}, CAST(NULL AS DECIMAL(23,8)) AS r_{m}" for m in measures)
    return f"""
    opened AS (SELECT report.m, account_rk, sum(balance_out) AS amount
               FROM report JOIN ft_balance_f ON on_date = eve GROUP BY ALL),
    turned AS (SELECT report.m, account_rk, count(*) AS days, sum(coalesce(debet_amount_rub, 0)) AS deb,
                      sum(coalesce(credit_amount_rub, 0)) AS cre
               FROM report JOIN dm_account_turnover_f ON on_date BETWEEN report.m AND till GROUP BY ALL),
    chart AS (SELECT report.m, chapter, CAST(ledger_account AS VARCHAR) AS ledger_account
              FROM report JOIN md_ledger_account_s ON called BETWEEN start_date AND end_date),
    kinds AS (SELECT report.m, currency_rk, CASE WHEN currency_code IN ('643', '810') THEN 'rub' ELSE 'val' END AS kind
              FROM report JOIN md_currency_d ON called BETWEEN data_actual_date AND data_actual_end_date),
    prices AS (SELECT report.m, currency_rk, reduced_cource AS price
               FROM report JOIN md_exchange_rate_d ON called BETWEEN data_actual_date AND data_actual_end_date),
    held AS (SELECT report.m, till, account_rk, currency_rk, char_type AS characteristic,
                    substr(account_number, 1, 5) AS ledger_account
             FROM report JOIN md_account_d ON called BETWEEN data_actual_date AND data_actual_end_date),
    line AS (SELECT held.m, till, chapter, ledger_account, characteristic, kind,
                    CAST(amount * {weight} AS DECIMAL(18,2)) * CASE kind WHEN 'rub' THEN 1.00000000 ELSE price END AS balance_in,
                    coalesce(deb, 0) AS turn_deb, coalesce(cre, 0) AS turn_cre
             FROM held JOIN chart USING (m, ledger_account) JOIN kinds USING (m, currency_rk)
                  LEFT JOIN prices USING (m, currency_rk) LEFT JOIN opened USING (m, account_rk)
                  LEFT JOIN turned USING (m, account_rk)),
    summed AS (SELECT m, till, chapter, ledger_account, characteristic,
               {by_kind("balance_in", none_of_it)},
               {by_kind("turn_deb", "0")},
               {by_kind("turn_cre", "0")}
               FROM line GROUP BY ALL),
    closed AS (SELECT *, {closing[0]},
               {closing[1]} FROM summed),
    form AS (SELECT *, balance_out_rub + balance_out_val AS balance_out_total FROM closed)
    SELECT m AS from_date, till AS to_date, chapter, ledger_account, characteristic,
           {columns}
    FROM form"""


def f101_oracle(preagg: bool) -> str:
    return with_views("WITH " + turnover_cte(MONTH_START, MONTH_END) + "," + _ONE_REPORT + "," + _f101_sql(not preagg))


def f101_all_oracle() -> str:
    return with_views("WITH " + turnover_cte(None, None) + "," + _EVERY_REPORT + "," + _f101_sql(True))


ORACLE["f101_report"] = f101_oracle(False)
ORACLE["f101_preagg"] = f101_oracle(True)


ORACLE.update({
    "valid_at": with_views("""
        SELECT a.account_rk, a.data_actual_date AS version_date, a.currency_rk, er.reduced_cource
        FROM md_account_d a
        LEFT JOIN md_exchange_rate_d er ON er.currency_rk = a.currency_rk
             AND a.data_actual_date BETWEEN er.data_actual_date AND er.data_actual_end_date"""),
    "valid_at_sorted": with_views("""
        SELECT a.account_rk, a.data_actual_date AS version_date, a.currency_rk, er.reduced_cource
        FROM md_account_d a
        LEFT JOIN md_exchange_rate_d er ON er.currency_rk = a.currency_rk
             AND a.data_actual_date BETWEEN er.data_actual_date AND er.data_actual_end_date"""),
    # one integer key for account and day, both sides computed once: no plan choice can join them otherwise
    "opening_balance": with_views("""
        WITH version AS MATERIALIZED (
            SELECT account_rk, data_actual_date, account_rk * 100000 + date_diff('day', DATE '1900-01-01', data_actual_date) - 1 AS k
            FROM md_account_d),
        opening AS MATERIALIZED (
            SELECT account_rk * 100000 + date_diff('day', DATE '1900-01-01', on_date) AS k, balance_out FROM ft_balance_f)
        SELECT account_rk, data_actual_date, balance_out FROM version LEFT JOIN opening USING (k)"""),
    "ledger_prefix_join": with_views("""
        SELECT a.account_rk, a.data_actual_date, s.ledger_account, s.chapter
        FROM md_account_d a
        JOIN md_ledger_account_s s ON substr(a.account_number, 1, 5) = CAST(s.ledger_account AS VARCHAR)"""),
    "posting_minmax": with_views("""
        SELECT oper_date AS oper_dates, max(credit_amount) AS max_credit_amount,
               min(credit_amount) AS min_credit_amount, max(debet_amount) AS max_debet_amount,
               min(debet_amount) AS min_debet_amount
        FROM ft_posting_f GROUP BY oper_date"""),
    "rate_dedup": with_views("SELECT DISTINCT * FROM md_exchange_rate_d"),
    "distinct_values": "SELECT DISTINCT c_mktsegment FROM customer",
    "group_count": "SELECT event_type, count(*) AS count FROM events GROUP BY event_type",
    "last_delta_id": with_views("SELECT coalesce(max(delta_id), 0) AS last_delta_id FROM deltas"),
    "discipline_join": """
        WITH dim(row_id, event_type, category) AS (VALUES
            (1, 'view', 'browse'), (2, 'click', 'browse'), (3, 'signup', 'account'),
            (4, 'login', 'account'), (5, 'purchase', 'order'), (6, 'refund', 'order'),
            (7, 'error', 'system')),
        cap AS (SELECT upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) AS event_type,
                       CAST(row_id AS BIGINT) AS row_id, category FROM dim),
        cnt AS (SELECT upper(substr(event_type, 1, 1)) || lower(substr(event_type, 2)) AS event_type,
                       count(*) AS count FROM events GROUP BY 1)
        SELECT cap.event_type, cap.row_id, cap.category, cnt.count
        FROM cap JOIN cnt ON cnt.event_type = cap.event_type""",
    "date_bounds": """
        SELECT d, CAST(date_trunc('month', d) AS DATE) AS month_start, last_day(d) AS month_end,
               CAST(date_trunc('month', d) - INTERVAL 1 DAY AS DATE) AS prev_month_end,
               strftime(d, '%Y-%m-%d') AS d_text
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)""",
    "month_spine": with_views("""
        SELECT m.month_start, CAST(g.day AS DATE) AS day
        FROM (SELECT DISTINCT CAST(date_trunc('month', oper_date) AS DATE) AS month_start FROM ft_posting_f) m,
        LATERAL (SELECT unnest(generate_series(m.month_start, last_day(m.month_start), INTERVAL 1 DAY)) AS day) g"""),
    "date_parse": """
        SELECT o_orderkey, strftime(o_orderdate, '%d.%m.%Y') AS d_text, CAST(o_orderdate AS DATE) AS d
        FROM orders""",
    "date_validate": """
        SELECT o_orderkey, d_text, CAST(try_strptime(d_text, '%Y-%m-%d') AS DATE) AS d,
               try_strptime(d_text, '%Y-%m-%d') IS NOT NULL AS is_valid
        FROM (SELECT o_orderkey,
                     strftime(o_orderdate, '%Y') || '-'
                     || CASE WHEN o_orderkey % 10 = 7 THEN '13' ELSE strftime(o_orderdate, '%m') END
                     || '-' || CAST(day(o_orderdate) AS VARCHAR) AS d_text
              FROM orders)""",
    "text_normalise": """
        SELECT c_custkey, replace(upper(regexp_replace(raw, '\\s', '', 'g')), '''', '') AS key_text,
               CAST(len(string_split(upper(regexp_replace(raw, '\\s', '', 'g')), ',')) AS INTEGER) AS n_parts,
               string_split(upper(regexp_replace(raw, '\\s', '', 'g')), ',')[1] AS first_part
        FROM (SELECT c_custkey, lower(c_name) || ', ' || ' ' || c_mktsegment || ''' ' AS raw FROM customer)""",
    "log_chunk": """
        SELECT doc_id, CAST(piece AS INTEGER) AS piece, row_number() OVER (ORDER BY doc_id, piece) AS record_id,
               substr(text, piece * 4000 + 1, 4000) AS message, 1 AS message_type,
               CAST(length(substr(text, piece * 4000 + 1, 4000)) AS INTEGER) AS chunk_chars
        FROM documents,
        LATERAL (SELECT unnest(generate_series(0, (length(text) - 1) // 4000)) AS piece)
        WHERE length(text) > 0""",
    "head_rows": "SELECT o_orderkey, o_custkey, o_orderdate FROM orders ORDER BY o_orderkey LIMIT 10",
    "nonempty_guard": """
        SELECT t AS table_name, true AS exists, n > 0 AS has_rows FROM (
            SELECT 'nation' AS t, (SELECT count(*) FROM nation) AS n UNION ALL
            SELECT 'customer', (SELECT count(*) FROM customer) UNION ALL
            SELECT 'supplier', (SELECT count(*) FROM supplier) UNION ALL
            SELECT 'orders', (SELECT count(*) FROM orders) UNION ALL
            SELECT 'lineitem', (SELECT count(*) FROM lineitem) UNION ALL
            SELECT 'events', (SELECT count(*) FROM events) UNION ALL
            SELECT 'documents', (SELECT count(*) FROM documents))
        UNION ALL SELECT 'no_such_table', false, false""",
})
ORACLE["posting_minmax_guarded"] = with_views("""
        WITH days AS (SELECT CAST(unnest(generate_series(min(oper_date), max(oper_date), INTERVAL 1 DAY)) AS DATE) AS d
                      FROM ft_posting_f)
        SELECT p.oper_date AS oper_dates, max(p.credit_amount) AS max_credit_amount,
               min(p.credit_amount) AS min_credit_amount, max(p.debet_amount) AS max_debet_amount,
               min(p.debet_amount) AS min_debet_amount
        FROM days JOIN ft_posting_f p ON p.oper_date = days.d
        WHERE days.d IN (SELECT oper_date FROM ft_posting_f)
        GROUP BY p.oper_date""")
ORACLE["posting_minmax_tvf"] = ORACLE["posting_minmax_guarded"]


_MASTER = """
    master AS (SELECT c_custkey AS account_rk, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation,
                      CAST(c_acctbal AS DECIMAL(18,2)) AS balance, c_mktsegment AS segment FROM customer),
    spent AS (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spent FROM orders GROUP BY o_custkey),
    batch AS (SELECT m.account_rk, m.name, m.nation, CAST(m.balance - s.spent AS DECIMAL(18,2)) AS balance,
                     'ACTIVE' AS segment
              FROM master m JOIN spent s ON s.o_custkey = m.account_rk
              UNION ALL
              SELECT 1000000000000 + s_suppkey, s_name, CAST(s_nationkey AS BIGINT),
                     CAST(s_acctbal AS DECIMAL(18,2)), 'SUPPLIER' FROM supplier)"""

_FOLD = """
    SELECT account_rk, data_actual_date, event_type, amount FROM deltas
    QUALIFY row_number() OVER (PARTITION BY {pk} ORDER BY delta_id DESC) = 1"""

_TURN_MONTH = with_views("WITH" + _turnover_sql(MONTH_START, MONTH_END))

ORACLE.update({
    "upsert_by_key": "WITH" + _MASTER + """
        SELECT * FROM master m WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.account_rk = m.account_rk)
        UNION ALL SELECT * FROM batch""",
    "upsert_partial": "WITH" + _MASTER + """
        SELECT m.account_rk, m.name, m.nation,
               CASE WHEN b.account_rk IS NOT NULL THEN b.balance ELSE m.balance END AS balance, m.segment
        FROM master m LEFT JOIN batch b ON b.account_rk = m.account_rk
        UNION ALL
        SELECT b.account_rk, NULL, NULL, b.balance, NULL FROM batch b
        WHERE NOT EXISTS (SELECT 1 FROM master m WHERE m.account_rk = b.account_rk)""",
    "delta_fold": with_views(_FOLD.format(pk="account_rk")),
    "delta_fold_history": with_views(_FOLD.format(pk="data_actual_date, account_rk")),
    "delta_merge_buckets": with_views(_FOLD.format(pk="account_rk")),
    "delta_merge": with_views(_FOLD.format(pk="account_rk")),
    "delta_incremental": with_views("""
        SELECT account_rk, data_actual_date, event_type, amount,
               CASE WHEN data_actual_date <= DATE '2024-01-15' THEN 1 ELSE 2 END AS run FROM deltas
        QUALIFY row_number() OVER (PARTITION BY account_rk ORDER BY delta_id DESC) = 1"""),
    "delta_stream": with_views(_FOLD.format(pk="account_rk")),
    "delta_scan": with_views("SELECT delta_id, account_rk, data_actual_date, event_type, amount FROM deltas"),
    "replace_slice": with_views("WITH" + _turnover_sql(MONTH_START, MONTH_END).replace(
        "FROM priced GROUP BY", "FROM priced WHERE day <> DATE '1998-03-03' GROUP BY")),
    "turnover_procedure": with_views("WITH" + _turnover_sql(MONTH_START, MONTH_END)),
    "f101_procedure": f101_oracle(False),
    "turnover_refresh": with_views("WITH" + _turnover_sql(None, None)),
    "f101_refresh": f101_all_oracle(),
    "csv_extract": with_views("SELECT * FROM ft_balance_f"),
    "csv_good_rows": with_views("""SELECT * FROM ft_balance_f
        WHERE account_rk % 90 <> 11 AND NOT (account_rk % 50 = 7 AND year(on_date) = 1996)"""),
    "csv_refused": with_views("""
        SELECT CASE WHEN bad_date THEN 'on_date' ELSE 'balance_out' END AS reason,
               CASE WHEN bad_date THEN '32' ELSE strftime(on_date, '%d') END || strftime(on_date, '.%m.%Y') || ';'
               || account_rk || ';' || currency_rk || ';' || CASE WHEN bad_sum THEN '~' ELSE '' END || balance_out AS line
        FROM (SELECT *, account_rk % 90 = 11 AS bad_sum, account_rk % 50 = 7 AND year(on_date) = 1996 AS bad_date
              FROM ft_balance_f) WHERE bad_sum OR bad_date"""),
    "csv_infer": with_views("""SELECT *, 'date,bigint,int,double,double' AS inferred_types FROM ft_posting_f"""),
    "mart_roundtrip": with_views("WITH" + _turnover_sql(None, None)),
    "detail_load": with_views("SELECT * FROM ft_balance_f"),
    "run_log": with_views("""
        SELECT sources, status, description, CAST(step AS INTEGER) AS step, true AS stamped FROM (
        SELECT 'ft_balance_f' AS sources, 'start_upload' AS status, 'upload into ft_balance_f' AS description, 1 AS step
        UNION ALL SELECT 'ft_balance_f', 'end_upload',
                         'ft_balance_f: ' || (SELECT count(*) FROM ft_balance_f) || ' rows in touched partitions', 2
        UNION ALL SELECT 'md_account_d', 'start_upload', 'upload into md_account_d', 1
        UNION ALL SELECT 'md_account_d', 'end_upload',
                         'md_account_d: ' || (SELECT count(*) FROM md_account_d) || ' rows', 2
        UNION ALL SELECT 'md_currency_d', 'error_exist_object', 'no extract for md_currency_d', 1)"""),
})
ORACLE["csv_tab_roundtrip"] = ORACLE["discipline_join"]

ORACLE.update({
    "literal_dim": """
        WITH dim(row_id, event_type, category) AS (VALUES
            (1, 'view', 'browse'), (2, 'click', 'browse'), (3, 'signup', 'account'),
            (4, 'login', 'account'), (5, 'purchase', 'order'), (6, 'refund', 'order'),
            (7, 'error', 'system'))
        SELECT CAST(row_id AS BIGINT) AS row_id, event_type, category,
               EXISTS (SELECT 1 FROM events e WHERE e.event_type = dim.event_type) AS seen
        FROM dim""",
    "detail_load_postings": with_views("SELECT * FROM ft_posting_f"),
    "detail_load_rates": with_views("SELECT * FROM md_exchange_rate_d"),
})

ORACLE.update({
    "valid_at_buckets": ORACLE["valid_at"],
    "date_rejects": "SELECT o_orderkey, d_text FROM (" + ORACLE["date_validate"] + ") WHERE NOT is_valid",
    "detail_load_currency": with_views("SELECT * FROM md_currency_d"),
    "detail_load_accounts": with_views("SELECT * FROM md_account_d"),
    "detail_load_ledger": with_views("SELECT *, '' AS pair_account FROM md_ledger_account_s"),
    "load_after_failure": with_views("SELECT * FROM md_account_d"),
})

ORACLE["log_identity"] = """
    SELECT record_id, true AS own_pid, true AS own_user, true AS own_database, true AS own_application,
           true AS no_address, true AS stamped FROM (""" + ORACLE["log_chunk"] + ")"

ORACLE["f101_all"] = f101_all_oracle()
