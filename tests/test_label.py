import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from tidecast import schemas as S
from tidecast.operators import label as L


def months(spark, customers, n):
    data = [
        (f"C{c:02d}", dt.date(2024, m, 28), float(100 * c + m), "VAREJO")
        for c in range(customers)
        for m in range(1, n + 1)
    ]
    return spark.createDataFrame(data, "cliente_id string, data_referencia date, saldo_m1 double, segmento string")


def test_forward_label(spark):
    df = spark.createDataFrame(
        [
            ("A", dt.date(2024, 1, 31), 100.0), ("A", dt.date(2024, 2, 29), 200.0),
            ("B", dt.date(2024, 1, 31), 50.0), ("B", dt.date(2024, 2, 29), 80.0),
        ],
        "cliente_id string, data_referencia date, saldo_m1 double",
    )
    assert rows(L.training_view(df), "cliente_id", S.LABEL) == [("A", 200.0), ("B", 80.0)]


def test_pass_through_and_stale_labels(spark):
    df = spark.createDataFrame([(1, 2.0)], "x int, saldo_alvo double")
    assert L.next_period_label(df).columns == ["x", "saldo_alvo"]
    assert L.drop_stale_labels(df).columns == ["x"]


def split_sizes(df):
    return {r["split"]: r["count"] for r in df.groupBy("split").count().collect()}


def test_split_of_three_months(spark):
    labelled = L.training_view(months(spark, 10, 3))
    # dates January and February: the cutoff falls on February, January rows label into it
    assert labelled.count() == 20
    sizes = split_sizes(L.temporal_split(labelled))
    assert sum(sizes.values()) == 20


def test_split_of_thirty_months(spark):
    data = [
        (f"C{i // 3}", dt.date(2024 + i // 12, 1 + i % 12, 1), float(i), "VAREJO") for i in range(30)
    ]
    df = spark.createDataFrame(
        data, "cliente_id string, data_referencia date, saldo_m1 double, segmento string"
    )
    labelled = L.training_view(df)
    assert labelled.count() == 20
    assert split_sizes(L.temporal_split(labelled)) == {"train": 12, "val": 3, "test": 4, None: 1}


def staggered(spark):
    """Ten customers, three consecutive months each, starting one month apart."""
    data = [
        (f"C{c:02d}", (dt.date(2024, 1, 1) + dt.timedelta(days=31 * (c + k))).replace(day=1), float(c + k))
        for c in range(10)
        for k in range(3)
    ]
    return spark.createDataFrame(data, "cliente_id string, data_referencia date, saldo_m1 double")


def test_no_training_label_from_the_test_span(spark):
    out = L.temporal_split(L.training_view(staggered(spark)))
    first_test = out.where("split = 'test'").agg(F.min("data_referencia")).first()[0]
    seen = out.where("split in ('train', 'val')").agg(F.max(S.NEXT_DATE)).first()[0]
    assert seen < first_test
    order = out.groupBy("split").agg(F.min("data_referencia").alias("lo"), F.max("data_referencia").alias("hi"))
    span = {r["split"]: (r["lo"], r["hi"]) for r in order.collect()}
    assert span["train"][1] < span["val"][0] < span["test"][0]


def test_split_against_pandas(lab):
    import pandas as pd

    out = L.temporal_split(lab.labelled).select("data_referencia", S.NEXT_DATE, "split").toPandas()
    d, nd = pd.to_datetime(out["data_referencia"]), pd.to_datetime(out[S.NEXT_DATE])
    cut = d.quantile(0.8)
    kept = (d < cut) & (nd < cut)
    val = d[kept].quantile(0.85)
    want = pd.Series([None] * len(out), dtype=object)
    want[d >= cut] = "test"
    want[kept & (d < val)] = "train"
    want[kept & (d >= val)] = "val"
    assert [w if isinstance(w, str) else None for w in want] == list(out["split"])


def test_few_rows_split_by_position(spark):
    sizes = split_sizes(L.temporal_split(L.training_view(months(spark, 4, 3))))
    # 8 rows: 6 before the test, of which 5 train
    assert sizes == {"train": 5, "val": 1, "test": 2}


def test_single_date_falls_back(spark):
    sizes = split_sizes(L.temporal_split(L.training_view(months(spark, 20, 2))))
    assert sizes == {"train": 13, "val": 3, "test": 4}


def test_hash_split_is_stable(lab):
    a = L.hash_split(lab.labelled).where("split = 'test'").count()
    b = L.hash_split(lab.labelled.repartition(7)).where("split = 'test'").count()
    assert a == b and 0 < a < lab.labelled.count()
