"""Property tests: operators against plain Python models on random inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kontor.operators import deltas as DL
from kontor.operators.upsert import upsert
from kontor.plans import runlog as RL

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.one_of(st.none(), st.integers(0, 6))
delta_rows = st.lists(st.tuples(st.integers(1000, 1005), keys, st.text("abc", max_size=3)), max_size=25)


def _unique_per_delta(rows):
    seen, out = set(), []
    for did, k, v in rows:
        if k is None or (did, k) not in seen:
            seen.add((did, k))
            out.append((did, k, v))
    return out


@SETTINGS
@given(rows=delta_rows, mirror=st.dictionaries(st.integers(0, 8), st.text("xyz", max_size=2), max_size=6))
def test_fold_equals_chain_and_model(spark, rows, mirror):
    rows = _unique_per_delta(rows)
    deltas = spark.createDataFrame(rows, "delta_id int, k bigint, v string")
    m = spark.createDataFrame(list(mirror.items()), "k bigint, v string")
    fold = sorted(map(tuple, DL.apply_deltas(m, deltas, ["k"]).collect()), key=repr)
    chain = sorted(map(tuple, DL.apply_deltas_chain(m, deltas, ["k"]).collect()), key=repr)
    model = dict(mirror)
    nulls = []
    for did, k, v in sorted(rows, key=lambda r: r[0]):
        if k is None:
            nulls.append((None, v))
        else:
            model[k] = v
    expected = sorted(list(model.items()) + nulls, key=repr)
    assert fold == chain == expected


@SETTINGS
@given(target=st.dictionaries(st.integers(0, 9), st.integers(0, 99), max_size=8),
       batch=st.dictionaries(st.integers(0, 12), st.integers(100, 199), max_size=8))
def test_upsert_plans_equal_model(spark, target, batch):
    t = spark.createDataFrame(list(target.items()), "k bigint, v bigint")
    b = spark.createDataFrame(list(batch.items()), "k bigint, v bigint")
    expected = sorted({**target, **batch}.items())
    for strategy in ("broadcast", "shuffle"):
        assert sorted(map(tuple, upsert(t, b, ["k"], strategy=strategy).collect())) == expected


@SETTINGS
@given(texts=st.lists(st.text("abé中 ", max_size=30), max_size=8), start=st.integers(1, 50))
def test_chunks_are_lossless_and_consecutive(spark, texts, start):
    rows = [(i, t) for i, t in enumerate(texts)]
    msgs = spark.createDataFrame(rows, "id bigint, message string")
    out = RL.chunk_messages(msgs, ["id"], start_id=start, size=7).collect()
    by_id = {}
    for r in out:
        by_id.setdefault(r["id"], []).append((r["piece"], r["message"], r["record_id"]))
    for i, t in rows:
        pieces = sorted(by_id.get(i, []))
        assert "".join(p[1] for p in pieces) == t
        assert len(pieces) == (len(t) + 6) // 7
    ids = sorted(r["record_id"] for r in out)
    assert ids == list(range(start, start + len(ids)))
    # ids follow (id, piece) order
    ordered = [r["record_id"] for r in sorted(out, key=lambda r: (r["id"], r["piece"]))]
    assert ordered == ids


# ---- turnover against the source's join-then-group semantics ---------------

import datetime as _dt  # noqa: E402
from decimal import ROUND_HALF_UP, Decimal  # noqa: E402

from kontor.plans import turnover as TO  # noqa: E402

_day = st.integers(1, 31).map(lambda d: _dt.date(2018, 1, d))
_money = st.one_of(st.none(), st.integers(-99999, 99999).map(lambda c: Decimal(c).scaleb(-2)))
_rate = st.integers(1, 999_999_999).map(lambda c: Decimal(c).scaleb(-8))


@st.composite
def ledgers(draw):
    accounts = []
    for rk in (1, 2, 3):
        for _ in range(draw(st.integers(0, 2))):
            lo = draw(st.sampled_from([_dt.date(2017, 12, 1), _dt.date(2018, 1, 1), _dt.date(2018, 1, 15)]))
            hi = draw(st.sampled_from([_dt.date(2018, 1, 20), _dt.date(2018, 1, 31), _dt.date(2018, 3, 1)]))
            accounts.append((lo, hi, rk, "30101", "A", draw(st.integers(1, 2)), "x"))
    rates = []
    for cur in (1, 2):
        for _ in range(draw(st.integers(0, 2))):
            lo, hi = sorted([draw(_day), draw(_day)])
            rates.append((lo, hi, cur, draw(_rate), "x"))
    postings = {}
    for _ in range(draw(st.integers(0, 8))):
        key = (draw(_day), draw(st.integers(1, 3)), draw(st.integers(1, 3)))
        postings[key] = (draw(_money), draw(_money))
    return accounts, rates, [(*k, *v) for k, v in postings.items()]


def _model(accounts, rates, postings):
    q = Decimal("1e-8")
    out = {}
    for d, cre_rk, deb_rk, cre_amt, deb_amt in postings:
        for side, rk, amt in (("c", cre_rk, cre_amt), ("d", deb_rk, deb_amt)):
            for lo, hi, a_rk, _, _, cur, _ in accounts:
                if a_rk != rk or not (lo <= d <= hi) or not (d.replace(day=1) <= lo <= _dt.date(2018, 1, 31)):
                    continue
                fx = [r for (rlo, rhi, rcur, r, _) in rates if rcur == cur and rlo <= d <= rhi] or [None]
                for r in fx:
                    rub = None if amt is None else amt * (r if r is not None else 1)
                    acc = out.setdefault((d, rk), [Decimal(0)] * 4)
                    i = 0 if side == "c" else 2
                    acc[i] += amt or 0
                    acc[i + 1] += rub or 0
    return {k: tuple(x.quantize(q, rounding=ROUND_HALF_UP) for x in v) for k, v in out.items()}


@SETTINGS
@given(ledger=ledgers())
def test_turnover_month_matches_join_then_group(spark, ledger):
    accounts, rates, postings = ledger
    acc = spark.createDataFrame(accounts, "data_actual_date date, data_actual_end_date date, account_rk bigint, "
                                          "account_number string, char_type string, currency_rk bigint, currency_code string")
    fx = spark.createDataFrame(rates, "data_actual_date date, data_actual_end_date date, currency_rk bigint, "
                                      "reduced_cource decimal(18,8), code_iso_num string")
    p = spark.createDataFrame(postings, "oper_date date, credit_account_rk bigint, debet_account_rk bigint, "
                                        "credit_amount decimal(18,2), debet_amount decimal(18,2)")
    got = {(r["on_date"], r["account_rk"]): (r["credit_amount"], r["credit_amount_rub"], r["debet_amount"],
                                             r["debet_amount_rub"])
           for r in TO.turnover_month(p, acc, fx, "2018-01-10").collect()}
    assert got == _model(accounts, rates, postings)
