"""Table registry: declared schemas and primary keys.

Spark does not enforce keys, so every table that is written by key
(upsert, merge, slice replacement) carries its key here and the
operators check it.  Types are declared, never inferred: CSV inference
turns account numbers into decimals and dd.MM.yyyy dates into strings.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


_SIMPLE = {
    "bigint": T.LongType(), "int": T.IntegerType(), "string": T.StringType(),
    "date": T.DateType(), "timestamp": T.TimestampType(), "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}


def _type(name: str) -> T.DataType:
    name = name.strip().lower()
    if name.startswith("decimal("):
        p, s = name[len("decimal("):-1].split(",")
        return T.DecimalType(int(p), int(s))
    return _SIMPLE[name]


def _schema(ddl: str) -> T.StructType:
    """'a bigint, b decimal(18,2)' -> StructType (no session needed)."""
    parts, depth, cur = [], 0, ""
    for ch in ddl:
        if ch == "," and depth == 0:
            parts.append(cur)
            cur = ""
            continue
        depth += ch == "("
        depth -= ch == ")"
        cur += ch
    parts.append(cur)
    fields = []
    for part in parts:
        name, typ = part.strip().split(None, 1)
        fields.append(T.StructField(name, _type(typ), True))
    return T.StructType(fields)


@dataclass(frozen=True)
class TableSpec:
    name: str
    ddl: str
    pk: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    description: str = ""
    schema: T.StructType = field(init=False, compare=False, repr=False)

    def __post_init__(self):
        object.__setattr__(self, "schema", _schema(self.ddl))

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


# Fixed values that must equal the source system's:
# domestic currency codes (rouble, old and new ISO numbers).
DOMESTIC_CURRENCY_CODES = ("643", "810")

MONEY = "decimal(18,2)"
RATE = "decimal(18,8)"
MART = "decimal(23,8)"

_F101_MEASURES = [
    f"{m}_{c}"
    for m in ("balance_in", "turn_deb", "turn_cre", "balance_out")
    for c in ("rub", "val", "total")
]

SPECS: dict[str, TableSpec] = {
    s.name: s
    for s in [
        # detail layer
        TableSpec(
            "ft_balance_f",
            f"on_date date, account_rk bigint, currency_rk bigint, balance_out {MONEY}",
            pk=("on_date", "account_rk"),
            partition_by=("on_date",),
            description="account balance at the end of a day",
        ),
        TableSpec(
            "ft_posting_f",
            "oper_date date, credit_account_rk bigint, debet_account_rk bigint, "
            f"credit_amount {MONEY}, debet_amount {MONEY}",
            pk=("oper_date", "credit_account_rk", "debet_account_rk"),
            partition_by=("oper_date",),
            description="double-entry postings, collapsed to one row per key",
        ),
        TableSpec(
            "md_account_d",
            "data_actual_date date, data_actual_end_date date, account_rk bigint, "
            "account_number string, char_type string, currency_rk bigint, currency_code string",
            pk=("data_actual_date", "account_rk"),
            description="accounts, effective-dated (closed interval)",
        ),
        TableSpec(
            "md_currency_d",
            "currency_rk bigint, data_actual_date date, data_actual_end_date date, "
            "currency_code string, code_iso_char string",
            pk=("currency_rk", "data_actual_date"),
        ),
        TableSpec(
            "md_exchange_rate_d",
            "data_actual_date date, data_actual_end_date date, currency_rk bigint, "
            f"reduced_cource {RATE}, code_iso_num string",
            pk=("data_actual_date", "currency_rk"),
        ),
        TableSpec(
            "md_ledger_account_s",
            "chapter string, chapter_name string, section_number int, section_name string, "
            "subsection_name string, ledger1_account int, ledger1_account_name string, "
            "ledger_account int, ledger_account_name string, characteristic string, "
            "is_resident string, is_reserve string, is_reserved string, is_loan string, "
            "is_reserved_assets string, is_overdue string, is_interest string, "
            "pair_account string, start_date date, end_date date, is_rub_only string, "
            "min_term string, min_term_measure string, max_term string, "
            "max_term_measure string, ledger_acc_full_name_translit string, "
            "is_revaluation string, is_correct string",
            pk=("ledger_account", "start_date"),
        ),
        # marts
        TableSpec(
            "dm_account_turnover_f",
            f"on_date date, account_rk bigint, credit_amount {MART}, credit_amount_rub {MART}, "
            f"debet_amount {MART}, debet_amount_rub {MART}",
            pk=("on_date", "account_rk"),
            partition_by=("on_date",),
        ),
        TableSpec(
            "dm_f101_round_f",
            "from_date date, to_date date, chapter string, ledger_account string, "
            "characteristic string, "
            + ", ".join(f"{m} {MART}, r_{m} {MART}" for m in _F101_MEASURES),
            pk=("from_date", "chapter", "ledger_account", "characteristic"),
            partition_by=("from_date",),
        ),
        TableSpec(
            "posting_minmax",
            f"oper_dates date, max_credit_amount {MONEY}, min_credit_amount {MONEY}, "
            f"max_debet_amount {MONEY}, min_debet_amount {MONEY}",
            pk=("oper_dates",),
        ),
        # logs
        TableSpec(
            "load_logs",
            "sources string, action_date timestamp, status string, description string, error string",
        ),
        TableSpec(
            "extract_logs",
            "action_date timestamp, status string, description string, error string",
            description="export / import / table-function runs",
        ),
        TableSpec(
            "etl_log",
            "action_date timestamp, status string, delta_id int, table_name string",
        ),
        TableSpec(
            "lg_messages",
            "record_id bigint, date_time timestamp, pid bigint, message string, message_type int, "
            "usename string, datname string, client_addr string, application_name string, "
            "backend_start string",
            pk=("record_id",),
        ),
    ]
}

F101_MEASURES = list(_F101_MEASURES)


def spec(name: str) -> TableSpec:
    return SPECS[name]
