"""Empty inputs give empty (or default) results, never errors."""

from kontor.operators import deltas as DL
from kontor.operators.sequence import sequential_ids
from kontor.plans import f101 as F101
from kontor.plans import runlog as RL
from kontor.plans import turnover as TO
from kontor.sources import testbed as TB
from kontor.specs import spec

SF = "/root/testdata/sf0.001"


def empty(spark, name):
    return spark.createDataFrame([], spec(name).schema)


def test_turnover_and_f101_on_empty_tables(spark):
    p, a, r = (empty(spark, n) for n in ("ft_posting_f", "md_account_d", "md_exchange_rate_d"))
    assert TO.turnover_month(p, a, r, "2018-01-10").count() == 0
    assert TO.account_turnover(p, a, r).count() == 0
    v = {n: TB.view(spark, SF, n) for n in TB.VIEWS}
    no_turn = empty(spark, "dm_account_turnover_f")
    rep = F101.f101_report(v["md_ledger_account_s"], v["md_account_d"], v["md_currency_d"], v["ft_balance_f"],
                           v["md_exchange_rate_d"], no_turn, "1998-03-03")
    rows = rep.collect()
    assert rows and all(r["turn_deb_total"] == 0 for r in rows)
    assert F101.f101_range(empty(spark, "md_ledger_account_s"), a, empty(spark, "md_currency_d"),
                           empty(spark, "ft_balance_f"), r, no_turn, "2018-01-01", "2018-02-28").count() == 0


def test_deltas_and_ids_on_empty_frames(spark):
    m = spark.createDataFrame([(1, "a")], "k bigint, v string")
    none = spark.createDataFrame([], "delta_id int, k bigint, v string")
    assert sorted(map(tuple, DL.apply_deltas(m, none, ["k"]).collect())) == [(1, "a")]
    assert sorted(map(tuple, DL.apply_deltas_chain(m, none, ["k"]).collect())) == [(1, "a")]
    assert DL.delta_ids(none) == []
    assert sequential_ids(spark.createDataFrame([], "k bigint"), ["k"]).count() == 0
    msgs = spark.createDataFrame([], "id bigint, message string")
    assert RL.chunk_messages(msgs, ["id"]).count() == 0
