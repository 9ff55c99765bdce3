"""Print the physical plans of the headline jobs over stored ledger tables.

Usage: python tools/explain.py [sf_dir] [job ...]
"""

from __future__ import annotations

import sys
import tempfile

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from kontor.operators import deltas as DL  # noqa: E402
from kontor.operators.upsert import upsert  # noqa: E402
from kontor.plans import f101 as F101  # noqa: E402
from kontor.plans import turnover as TO  # noqa: E402
from kontor.queries_io import MIRROR_PK, MIRROR_SCHEMA, _master, _master_batch  # noqa: E402
from kontor.session import build_session  # noqa: E402
from kontor.sources import testbed as TB  # noqa: E402

NAMES = ("ft_posting_f", "md_account_d", "md_currency_d", "md_exchange_rate_d", "ft_balance_f",
         "md_ledger_account_s", "deltas")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    jobs = sys.argv[2:]
    spark = build_session("local[8]", shuffle_partitions=16)
    root = tempfile.mkdtemp(prefix="kontor-explain-")
    for n in NAMES:
        TB.view(spark, sf, n).write.parquet(f"{root}/{n}")
    v = {n: spark.read.parquet(f"{root}/{n}") for n in NAMES}
    P, A, R = v["ft_posting_f"], v["md_account_d"], v["md_exchange_rate_d"]
    TO.account_turnover(P, A, R).write.parquet(f"{root}/turn")
    T = spark.read.parquet(f"{root}/turn")
    plans = {
        "turnover_month": lambda: TO.turnover_month(P, A, R, "1998-03-03"),
        "turnover_all": lambda: TO.account_turnover(P, A, R),
        "f101_report": lambda: F101.f101_report(v["md_ledger_account_s"], A, v["md_currency_d"],
                                                v["ft_balance_f"], R, T, "1998-03-03"),
        "f101_all": lambda: F101.f101_range(v["md_ledger_account_s"], A, v["md_currency_d"], v["ft_balance_f"],
                                            R, T, "1995-01-01", "2001-08-31"),
        "delta_fold": lambda: DL.apply_deltas(spark.createDataFrame([], MIRROR_SCHEMA), v["deltas"], MIRROR_PK,
                                              validate=False),
        "upsert_by_key": lambda: upsert(_master(spark, sf), _master_batch(spark, sf), ["account_rk"], check=False),
    }
    for name in jobs or plans:
        print("=" * 30, name)
        plans[name]().explain("formatted")


if __name__ == "__main__":
    main()
