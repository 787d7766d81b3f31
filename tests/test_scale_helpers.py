"""Hot keys and large groups against brute force."""

import datetime as dt
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidecast.operators import merge as MG
from tidecast.operators import panel as P
from tidecast.operators.prefix import running_sum
from tidecast.operators.quantiles import exact_quantiles, grouped_quantiles


def skewed(n=3000, seed=3):
    """A third of the rows on one account, half of those on one day."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        hot = i % 3 == 0
        acc = "HOT" if hot else f"A{rnd.randrange(40):02d}"
        day = 7 if hot and i % 2 == 0 else rnd.randrange(1, 28)
        out.append((acc, dt.date(2024, 1, day), f"TX{rnd.randrange(10**6):06d}-{i:05d}", round(rnd.uniform(-9, 9), 2)))
    return out


@pytest.mark.parametrize("ranges", [1, 40])
def test_running_sum_on_a_hot_key(spark, monkeypatch, ranges):
    data = skewed()
    data += [("HOT", None, "TX-A", 1.5), ("HOT", dt.date(2024, 1, 9), None, 2.5), (None, dt.date(2024, 1, 1), "TX-B", 3.0), (None, None, "TX-C", 4.0)]
    df = spark.createDataFrame(data, "acc string, d date, tx string, v double").repartition(9)
    monkeypatch.setattr(type(df), "repartitionByRange", lambda self, *c, f=type(df).repartitionByRange: f(self, ranges, *c))
    got = running_sum(df, ["acc"], [F.col("d"), F.col("tx")], F.col("v").cast("decimal(18,2)"), "run")
    want = {}
    low = lambda x: (x is not None, x or dt.date.min if not isinstance(x, str) else x)
    for acc, grp in itertools.groupby(sorted(data, key=lambda r: (r[0] or "", low(r[1]), (r[2] is not None, r[2] or ""))), key=lambda r: r[0]):
        cents = 0
        for r in grp:
            cents += round(r[3] * 100)
            want[r[0], r[1], r[2]] = cents
    assert {(r["acc"], r["d"], r["tx"]): round(float(r["run"]) * 100) for r in got.collect()} == want
    assert got.columns == ["acc", "d", "tx", "v", "run"]


def test_keep_newest_cuts_inside_a_date(spark):
    data = [(f"C{i:03d}", dt.date(2024, 1 + i % 3, 28), float(i)) for i in range(300)]
    data += [(None, dt.date(2024, 2, 28), 1.0), ("C001", dt.date(2024, 2, 28), 0.5), ("C999", None, 2.0), (None, None, 3.0)]
    df = spark.createDataFrame(data, "cliente_id string, data_referencia date, saldo_m1 double").repartition(7)
    low = lambda r: (-(r[1] or dt.date.min).toordinal(), r[0] is not None, r[0] or "", r[1] is not None, r[2])
    for n in (150, 100, 1, 303, 304, 10_000, 0):
        got = sorted(map(tuple, MG.keep_newest(df, n).collect()), key=low)
        assert got == sorted(data, key=low)[:n]


def test_running_balance_on_all_accounts(lab):
    b = lab.bank
    cols = ["transaction_id", "customer_id", "balance"]
    one = sorted(map(tuple, P.running_balance(b.transactions, b.accounts).select(*cols).collect()))
    two = sorted(map(tuple, P.running_balance(b.transactions.repartition(13), b.accounts).select(*cols).collect()))
    assert one == two and len(one) > 500


def test_panel_of_a_hot_account(spark):
    """Thousands of movements on one account still reduce to its months."""
    import datetime as d

    from bankdata import bank, frame, transactions

    from tidecast import schemas as S

    b = bank(spark)
    base = transactions()
    extra = [
        {**base[0], "transaction_id": f"H{i:06d}", "amount": 1.0, "transaction_date": d.date(2015, 1 + i % 8, 1 + i % 28)}
        for i in range(4000)
    ]
    b.transactions = b.transactions.unionByName(frame(spark, S.TRANSACTIONS, extra)).repartition(5)
    got = P.monthly_panel(b, "2016-01-01", min_months=1).where("cliente_id = 'CUST000001'")
    by_month = {m: sum(1.0 for i in range(4000) if 1 + i % 8 <= m) for m in range(1, 9)}
    want = {6: 350 + by_month[6], 7: 750 + by_month[7], 8: 300 + by_month[8]}
    assert {r["mes"]: r["saldo_m1"] for r in got.collect()} == want


def values(kind):
    rnd = np.random.default_rng(5)
    if kind == "smooth":
        return rnd.normal(size=20_000)
    if kind == "tied":
        return np.where(rnd.random(20_000) < 0.4, 3.0, rnd.integers(0, 50, 20_000).astype(float))
    return np.array([1.0, 2.0])


@pytest.mark.parametrize("kind", ["smooth", "tied", "tiny"])
@pytest.mark.parametrize("limit", [1, 500, 10**9])
def test_quantiles_are_exact_whatever_the_bracket(spark, kind, limit):
    x = values(kind)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    probs = [0.0, 0.25, 0.5, 0.8, 0.99, 1.0]
    got = exact_quantiles(df, {f"q{i}": (F.col("x"), p) for i, p in enumerate(probs)}, limit=limit, accuracy=100)
    for i, p in enumerate(probs):
        assert got[f"q{i}"] == pytest.approx(np.quantile(x, p), abs=1e-9)


def test_quantile_skips_nulls_and_empty(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None)], "a double, b double")
    assert exact_quantiles(df, {"a": (F.col("a"), 0.5), "b": (F.col("b"), 0.5)}) == {"a": 2.0, "b": None}


def test_panel_plan_aggregates_before_it_joins(lab):
    plan = P.account_months(lab.bank.transactions, lab.bank.accounts)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    join = next(i for i, s in enumerate(lines) if "Join" in s)
    assert any("Aggregate" in s for s in lines[join:])


def test_no_python_no_cartesian_in_the_report_plans(lab):
    from tidecast.plans import reports as R

    for df in (R.model_benchmark(lab.metrics, R.unified(lab.predictions)), R.error_by_segment(R.unified(lab.predictions))):
        text = df._jdf.queryExecution().executedPlan().toString()
        for bad in ("Cartesian", "NestedLoop", "ArrowEval", "BatchEvalPython"):
            assert bad not in text


def test_metrics_have_the_same_bits_in_any_layout(spark):
    from tidecast.functions import scoring as SC

    r = random.Random(4)
    data = [(i % 3, r.gauss(1000, 900), r.gauss(1000, 900)) for i in range(4000)] + [(1, 0.0, 0.0), (2, 0.0, 5.0), (7, 2.5, 2.0), (7, 2.5, 3.0), (8, 1.0, 1.0)]
    df = spark.createDataFrame(data, "k int, y double, p double")
    got = []
    for parts in (1, 3, 17):
        out = df.orderBy(F.rand(parts)).repartition(parts).groupBy("k").agg(*SC.metric_aggregates("y", "p")).orderBy("k").collect()
        got.append([tuple(x) for x in out])
    assert got[0] == got[1] == got[2]
    y, p = (np.array([x[i] for x in data if x[0] == 0]) for i in (1, 2))
    m = {n: v for n, v in zip(df.groupBy("k").agg(*SC.metric_aggregates("y", "p")).columns, got[0][0])}
    assert m["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum(), rel=1e-12)
    assert m["rmse"] == pytest.approx(np.sqrt(((y - p) ** 2).mean()), rel=1e-13)
    assert m["smape"] == pytest.approx((abs(y - p) / ((abs(y) + abs(p)) / 2)).mean() * 100, rel=1e-13)
    assert got[0][3][1:] and [x for x in got[0] if x[0] == 7][0][3] == 0.0  # equal actuals, not met: r2 is 0


def test_last_before_over_many_ranges(spark):
    from tidecast.operators.prefix import last_before

    r = random.Random(6)
    rows = [(i, r.choice([None, None, None, f"v{i}"])) for i in range(3000)]
    df = spark.createDataFrame(rows, "t int, v string").repartition(5)
    got = {x["t"]: x["live"] for x in last_before(df, [F.col("t")], F.col("v"), "live").collect()}
    want, now = {}, None
    for t, v in rows:
        now = v or now
        want[t] = now
    assert got == want
    sparse = spark.createDataFrame([(i, "only" if i == 7 else None) for i in range(500)], "t int, v string")
    assert {x["live"] for x in last_before(sparse, [F.col("t")], F.col("v"), "live").where("t >= 7").collect()} == {"only"}


@pytest.mark.parametrize("limit, accuracy", [(500_000, 10_000), (40, 10_000), (40, 20), (1, 10_000)])
def test_grouped_quantiles(spark, limit, accuracy):
    rng = np.random.default_rng(limit)
    data = {"hot": rng.normal(0, 1e6, 5000), "tied": np.repeat([3.5, 7.25], [2000, 900]), "one": np.array([4.0]), None: np.round(rng.exponential(50, 700)), "two": np.array([1.0, 2.0])}
    data |= {f"g{i}": np.round(rng.normal(i, 30, 3 + i), 1) for i in range(40)}
    rows = [(g, float(v)) for g, values in data.items() for v in values] + [("hot", None), ("void", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(6)
    for prob in (0.0, 0.8, 0.95, 1.0):
        got = {r["g"]: (r["n"], r["q"]) for r in grouped_quantiles(df, ["g"], F.col("x"), prob, limit, accuracy).collect()}
        assert got.pop("void") == (0, None) and got.keys() == data.keys()
        for g, values in data.items():
            assert got[g][0] == len(values) and got[g][1] == pytest.approx(float(np.quantile(values, prob)), rel=1e-12, abs=1e-9)
