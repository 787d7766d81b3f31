import datetime as dt

import pytest
from bankdata import bank, frame, transactions
from conftest import rows
from pyspark.sql import functions as F

from tidecast import schemas as S
from tidecast.functions import calendar as C
from tidecast.functions import money as M
from tidecast.functions import recode as R
from tidecast.operators import label as L
from tidecast.operators import panel as P

AS_OF = "2016-01-01"


@pytest.fixture(scope="module")
def panel(spark):
    return P.monthly_panel(bank(spark), AS_OF, min_months=2).cache()


def golden(cid, dates, lags):
    return [(cid, d, *lags[i]) for i, d in enumerate(dates)]


def test_golden_balances(panel):
    dates = [dt.date(2015, 6, 30), dt.date(2015, 7, 31), dt.date(2015, 8, 31)]
    # opening balances of 500 and 1200 carried under the running sums
    one = [(350, 700, 400, 650, 450, 600), (750, 350, 700, 400, 650, 450), (300, 750, 350, 700, 400, 650)]
    two = [
        (1050, 1500, 1100, 1450, 1150, 1400),
        (1550, 1050, 1500, 1100, 1450, 1150),
        (1000, 1550, 1050, 1500, 1100, 1450),
    ]
    want = golden("CUST000001", dates, one) + golden("CUST000002", dates, two)
    assert rows(panel, "cliente_id", "data_referencia", *S.LAGS) == sorted(want)


def test_golden_flows_and_profile(panel):
    got = rows(panel, "cliente_id", "mes", "valor_creditos_mes", "valor_debitos_mes")
    assert got == [
        ("CUST000001", 6, 0.0, 350.0),
        ("CUST000001", 7, 400.0, 0.0),
        ("CUST000001", 8, 0.0, 450.0),
        ("CUST000002", 6, 0.0, 450.0),
        ("CUST000002", 7, 500.0, 0.0),
        ("CUST000002", 8, 0.0, 550.0),
    ]
    cols = [
        "segmento", "genero", "uf", "score_credito", "possui_credito", "possui_investimento", "possui_seguro",
        "renda_mensal", "qtd_produtos_ativos", "idade", "tempo_relacionamento",
    ]
    assert rows(panel.select("cliente_id", *cols).distinct()) == [
        ("CUST000001", "VAREJO", "M", "VIC", 650, 0, 0, 0, 1000.0, 1, 36, 73),
        ("CUST000002", "PRIVATE", "F", "VIC", 850, 1, 1, 1, 1000.0, 1, 36, 73),
    ]


def test_columns_and_key(panel):
    assert panel.columns == S.PANEL_COLUMNS and len(panel.columns) == 27
    assert panel.select("cliente_id", "data_referencia").distinct().count() == panel.count()


def test_default_history_is_longer_than_the_sample(spark):
    assert P.monthly_panel(bank(spark), AS_OF).isEmpty()
    with pytest.raises(ValueError):
        P.require_rows(P.monthly_panel(bank(spark), AS_OF), "panel")


def test_slices(panel):
    assert P.month_slice(panel, "2015-08").count() == 2
    history, batch = P.split_at_month(panel, "2015-08")
    assert (history.count(), batch.count()) == (4, 2)
    assert rows(P.cutoff_month(panel, -1)) == [("2015-08", 2, 3)]
    assert rows(P.cutoff_month(panel, -3)) == [("2015-07", 1, 3)]


def test_labels_of_golden_panel(panel):
    got = rows(L.training_view(panel), "cliente_id", "saldo_m1", S.LABEL)
    assert got == [
        ("CUST000001", 350.0, 750.0),
        ("CUST000001", 750.0, 300.0),
        ("CUST000002", 1050.0, 1550.0),
        ("CUST000002", 1550.0, 1000.0),
    ]


def test_first_customers(spark):
    one = P.monthly_panel(bank(spark), AS_OF, min_months=1, max_customers=1)
    assert {r[0] for r in one.select("cliente_id").collect()} == {"CUST000001"}


def test_month_end_balance_is_the_last_running_balance(spark):
    b = bank(spark)
    last = {}
    for r in P.running_balance(b.transactions, b.accounts).collect():
        key = (r["account_id"], r["transaction_date"].replace(day=1))
        if key not in last or r["transaction_date"] >= last[key][0]:
            last[key] = (r["transaction_date"], r["balance"])
    months = P.account_month_report(b.transactions, b.accounts).collect()
    assert {(r["account_id"], r["period"]): r["saldo_conta"] for r in months} == {k: v[1] for k, v in last.items()}


def test_unknown_account_and_pending_rows_drop_out(spark):
    b = bank(spark)
    extra = transactions()[:2]
    extra[0] = {**extra[0], "account_id": "NONE", "transaction_id": "X1"}
    extra[1] = {**extra[1], "status": "pending", "transaction_id": "X2"}
    tx = b.transactions.unionByName(frame(spark, S.TRANSACTIONS, extra))
    same = P.account_month_report(tx, b.accounts)
    assert rows(same) == rows(P.account_month_report(b.transactions, b.accounts))
    assert P.keep_status(tx, "").count() == 18
    assert P.keep_status(tx.drop("status")).count() == 18


def test_scalar_rules(spark):
    df = spark.createDataFrame(
        [("deposit", 10.0), ("withdrawal", 10.0), ("payment", 10.0), ("transfer", 10.0), ("fee", 10.0)],
        "transaction_type string, amount double",
    )
    got = [r[0] for r in df.select(M.signed_amount()).collect()]
    assert got == [10.0, -10.0, -10.0, -5.0, 0.0]
    one = spark.range(1)
    check = one.select(
        M.opening_balance(F.lit(None).cast("double")).alias("none"),
        M.opening_balance(F.lit(5000.0)).alias("tenth"),
        M.clip(F.lit(None).cast("double"), 1.0, 2.0).alias("clip"),
        R.income_segment(F.lit(8000.0)).alias("seg"),
        R.gender_letter(F.lit(None).cast("string")).alias("g"),
        R.safe_int(F.lit("x7")).alias("i"),
        C.age_years(F.lit("2016-01-01").cast("date"), F.lit("2010-01-01").cast("date")).alias("age"),
        M.pct_error(F.lit(0.0), F.lit(5.0)).alias("pct"),
    ).first()
    assert tuple(check) == (100.0, 500.0, None, "PRIME", "N", 0, 18, 0.0)
