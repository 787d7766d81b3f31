import datetime as dt
import itertools
import time

import pytest
from bankdata import bank
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidecast import schemas as S
from tidecast.operators import merge as MG
from tidecast.operators import panel as P
from tidecast.operators import quality as QA
from tidecast.operators import reconcile as RC
from tidecast.session import fresh_path, shared_root
from tidecast.sinks import ledger as LG
from tidecast.sinks import tables as TB
from tidecast.sources import bank as SB
from tidecast.sources import tables as ST
from tidecast.streaming import ingest as IN

LEDGER = "key string, version string, marked_at timestamp"


def at(text):
    return dt.datetime.fromisoformat(text)


def test_shared_folder_comes_from_the_session(spark):
    root = shared_root(spark)
    assert fresh_path(spark, "x").startswith(root + "/x-")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_without_a_setting_the_warehouse_holds_the_stages():
    from types import SimpleNamespace

    known = {"spark.sql.warehouse.dir": "hdfs:///wh/"}
    assert shared_root(SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: known.get(k, d)))) == "hdfs:///wh/_stages"
    known["spark.checkpoint.dir"] = "hdfs:///shared"
    assert shared_root(SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: known.get(k, d)))) == "hdfs:///shared"


def test_changed_file_is_new(spark):
    ledger = spark.createDataFrame([("a.csv", "old", at("2024-01-01"))], LEDGER)
    listing = spark.createDataFrame([("a.csv", "new"), ("b.csv", "1")], "key string, version string")
    assert rows(LG.unprocessed(listing, ledger)) == [("a.csv", "new"), ("b.csv", "1")]
    again = ledger.union(spark.createDataFrame([("a.csv", "new", at("2024-01-02"))], LEDGER))
    assert rows(LG.unprocessed(listing, again)) == [("b.csv", "1")]
    back = again.union(spark.createDataFrame([("a.csv", "old", at("2024-01-03"))], LEDGER))
    assert rows(LG.unprocessed(listing, back)) == [("a.csv", "new"), ("b.csv", "1")]


@pytest.mark.parametrize("minutes, due", [(2, False), (15, True)])
def test_throttle(spark, minutes, due):
    now = F.lit("2024-01-01 12:00:00").cast("timestamp")
    mark = at("2024-01-01T12:00:00+00:00") - dt.timedelta(minutes=minutes)
    ledger = spark.createDataFrame([("k", "v", mark)], LEDGER)
    assert LG.due(ledger, now, 10).first()["due"] is due
    assert LG.due(ledger.where("false"), now, 10).first()["due"] is True


def test_run_ledger_keeps_the_last_phase(spark):
    path = fresh_path(spark, "runs")
    assert LG.read_run_ledger(spark, path).isEmpty()
    one = spark.range(1).select(F.lit(1.5).alias("x"))
    LG.append_run(spark, path, "r1", "validate", "validated", one)
    LG.append_run(spark, path, "r1", "finalize", "success", one)
    got = LG.run_result(LG.read_run_ledger(spark, path), "r1").first()
    assert (got["phase"], got["status"], got["payload"]) == ("finalize", "success", '{"x":1.5}')


def test_key_lists():
    assert ST.parse_key_list('["a.csv", "b.csv"]') == ["a.csv", "b.csv"]
    assert ST.parse_key_list(" a.csv, ,b.csv ") == ["a.csv", "b.csv"]
    assert ST.parse_key_list(["a.csv", ""]) == ["a.csv"]
    assert ST.parse_key_list("") == [] and ST.parse_key_list(None) == []


def test_bank_loader_names_what_is_missing(spark):
    root = fresh_path(spark, "bank")
    b = bank(spark)
    TB.write_csv(b.customers, f"{root}/customers.csv")
    with pytest.raises(FileNotFoundError, match="accounts.csv.*transactions.parquet"):
        SB.load_bank(spark, root)
    TB.write_csv(b.accounts, f"{root}/accounts.csv")
    b.transactions.withColumn("transaction_date", F.col("transaction_date").cast("string")).write.parquet(
        f"{root}/transactions.parquet"
    )
    loaded = SB.load_bank(spark, root)
    panel = P.monthly_panel(loaded, "2016-01-01", min_months=2)
    want = P.monthly_panel(b, "2016-01-01", min_months=2)
    keep = ["cliente_id", "data_referencia", *S.LAGS, "renda_mensal", "uf"]
    assert rows(panel, *keep) == rows(want, *keep)
    assert rows(panel.select("possui_credito").distinct()) == [(0,)]


def test_incoming_files_may_differ_in_columns(spark):
    root = fresh_path(spark, "in")
    TB.write_csv(spark.createDataFrame([(1, "x")], "a int, b string"), f"{root}/1.csv")
    TB.write_csv(spark.createDataFrame([(2, 7)], "a int, c int"), f"{root}/2.csv")
    got = ST.read_incoming(spark, "1.csv,2.csv", root=f"{root}/")
    assert sorted(map(str, got.select("a", "b", "c").collect())) == sorted(
        ["Row(a=1, b='x', c=None)", "Row(a=2, b=None, c=7)"]
    )
    assert ST.read_incoming(spark, " , ") is None


def test_listing_sees_rewritten_files(spark):
    root = fresh_path(spark, "list")
    TB.write_csv(spark.range(3).toDF("a"), root, single=True)
    first = ST.list_files(spark, root).collect()
    assert len(first) == 1 and first[0]["key"].endswith(".csv")
    assert ST.list_files(spark, root + "-none").isEmpty()
    plan = ST.list_files(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
    TB.write_csv(spark.range(4).toDF("a"), root, single=True)
    assert ST.list_files(spark, root).first()["version"] != first[0]["version"]


def test_prediction_sink_replaces_partitions(spark):
    path = fresh_path(spark, "pred")

    def batch(year, n, run):
        return spark.range(n).select(
            F.format_string("C%d", "id").alias("cliente_id"), F.lit(run).alias("run_id"),
            F.lit(year).alias("ano"), F.lit(1).alias("mes"), F.lit("VAREJO").alias("segmento"),
        )

    TB.write_predictions(batch(2023, 5, "r1").union(batch(2024, 5, "r1")), path)
    TB.write_predictions(batch(2024, 2, "r2"), path)
    TB.write_predictions(batch(2024, 2, "r2"), path)
    got = ST.read_predictions(spark, path).groupBy("ano", "run_id").count()
    assert rows(got) == [(2023, "r1", 5), (2024, "r2", 2)]
    TB.write_predictions(batch(2024, 2, "r3"), path, append=True)
    assert ST.read_predictions(spark, path).count() == 9


def test_metric_defaults(spark):
    row = spark.createDataFrame([("r", "2024-01-01", "12", None)], "run_id string, run_date string, total_linhas string, wape double")
    got = TB.metric_defaults(row).first()
    assert (got["total_linhas"], got["linhas_adicionadas"], got["champion_wape"]) == (12, 0, 0.0)
    assert (got["is_champion"], got["metricas_segmento"], got["modelo_versao"]) == (False, "{}", "")


def test_nested_decimals(spark):
    df = spark.sql("SELECT struct(1.5D AS a, array(0.1D, NULL) AS b, map('k', 2.5D) AS c, 'x' AS d, 3 AS e) AS p")
    got = LG.decimals_inside(df, "p").schema["p"].dataType.simpleString()
    assert got == "struct<a:decimal(38,10),b:array<decimal(38,10)>,c:map<string,decimal(38,10)>,d:string,e:int>"


def panel_rows(spark, customers, months, value=0.0):
    data = [
        (f"CUST{c:06d}", dt.date(2024, m, 28), value + c + m, 2024, m) for c in range(customers) for m in months
    ]
    cols = "cliente_id string, data_referencia date, saldo_m1 double, ano int, mes int"
    return spark.createDataFrame(data, cols)


def test_ingest_keeps_history(spark):
    from tidecast.operators import label as L

    path = fresh_path(spark, "panel")
    TB.write_panel(panel_rows(spark, 20, [1, 2, 3]), path)
    report = IN.ingest_batch(spark, panel_rows(spark, 22, [4]), path, "r1").first()
    assert (report["rows_before"], report["rows_added"], report["total_rows"]) == (60, 22, 82)
    assert L.training_view(IN.read_panel(spark, path)).count() == 60
    again = IN.ingest_batch(spark, panel_rows(spark, 22, [4], value=100.0), path, "r2").first()
    assert (again["rows_added"], again["total_rows"]) == (0, 82)
    top = IN.read_panel(spark, path).where("mes = 4").agg(F.min("saldo_m1")).first()[0]
    assert top == 104.0


def test_replay_equals_one_shot(spark):
    root = fresh_path(spark, "replay")
    TB.write_panel(panel_rows(spark, 5, [1, 2]), f"{root}/panel")
    for m in (3, 4, 5):
        batch = TB.conform(panel_rows(spark, 6, [m]), S.PANEL)
        batch.coalesce(1).write.option("header", True).csv(f"{root}/in/m{m}")
    n = IN.replay(spark, f"{root}/in", f"{root}/panel", f"{root}/cp", f"{root}/ledger", files_per_batch=1)
    assert n == 3
    assert IN.replay(spark, f"{root}/in", f"{root}/panel", f"{root}/cp", f"{root}/ledger") == 0
    got = rows(IN.read_panel(spark, f"{root}/panel"), "cliente_id", "data_referencia", "saldo_m1")
    want = panel_rows(spark, 5, [1, 2]).union(panel_rows(spark, 6, [3, 4, 5]))
    assert got == rows(want, "cliente_id", "data_referencia", "saldo_m1")
    assert LG.latest_versions(LG.read_ingest_ledger(spark, f"{root}/ledger")).count() == 3


def test_ledger_of_stream_and_batch_agree(spark):
    from tidecast import jobs as J

    cfg = J.Config(root=fresh_path(spark, "job"), run_id="r1")
    incoming = f"{cfg.root}/in"
    TB.write_panel(panel_rows(spark, 5, [1, 2]), cfg.panel)
    TB.write_csv(TB.conform(panel_rows(spark, 5, [3]), S.PANEL), f"{incoming}/m3", single=True)
    assert J.validate(spark, cfg, incoming).first()["status"] == "validated"
    assert J.check_new_data(spark, cfg, incoming).first()["incoming_count"] == 1
    assert J.ingest(spark, cfg, incoming) == 1
    assert J.check_new_data(spark, cfg, incoming).first()["skip_reason"] == "no_new_data"
    assert J.ingest_changed(spark, cfg, incoming) is None
    TB.write_csv(TB.conform(panel_rows(spark, 7, [3], value=9.0), S.PANEL), f"{incoming}/m3", single=True)
    report = J.ingest_changed(spark, cfg, incoming).first()
    assert (report["rows_incoming"], report["rows_added"], report["total_rows"]) == (7, 2, 17)
    assert IN.read_panel(spark, cfg.panel).where("mes = 3").agg(F.min("saldo_m1")).first()[0] == 12.0
    assert J.finalise(spark, cfg).first()["status"] == "success"
    assert J.check_new_data(spark, cfg, incoming).first()["has_new_data"] is False


def test_merge_rules(spark):
    base, batch = panel_rows(spark, 2, [1]), panel_rows(spark, 3, [1], value=50.0)
    assert MG.append(base, batch).count() == 5
    merged = MG.upsert(base, batch)
    assert merged.count() == 3 and merged.agg(F.min("saldo_m1")).first()[0] == 51.0
    assert rows(MG.latest_per_customer(panel_rows(spark, 2, [1, 2, 3])), "cliente_id", "saldo_m1") == [
        ("CUST000000", 3.0), ("CUST000001", 4.0)
    ]


@pytest.mark.parametrize(
    "ids, want",
    [
        (["CUST000007", "CUST000041"], (42, "CUST000042")),
        (["CLI_00009", "CLI_00003"], (10, "CLI_00010")),
        (["x", "y", "x"], (3, "CLI_00003")),
    ],
)
def test_next_customer(spark, ids, want):
    df = spark.createDataFrame([(i,) for i in ids], "cliente_id string")
    assert tuple(MG.next_customer(df).first()) == want


def test_fingerprint(spark):
    import hashlib

    df = panel_rows(spark, 3, [1, 2])
    want = hashlib.sha256(b"6|2024-02-28T00:00:00").hexdigest()[:16]
    assert tuple(MG.dataset_fingerprint(df).first()) == (6, want)


def test_field_diffs(spark):
    e = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", None)], "k int, s string, n int")
    a = spark.createDataFrame([(1, "a", 2), (2, "b", 2), (4, "d", None)], "k int, s string, n int")
    diffs = RC.field_diffs(e, a, ["k"], ["s", "n"])
    assert rows(diffs.select("k", RC.diff_text().alias("t"))) == [
        (1, "n: expected=1 actual=2"), (3, "s: expected=c actual=None"), (4, "s: expected=None actual=d"),
    ]
    got = RC.summarise(diffs, ["k"], max_items=2).first()
    assert (got["passed"], got["diff_count"], len(got["diffs"]), got["truncated"]) == (False, 3, 2, True)
    none = RC.summarise(RC.field_diffs(e, e, ["k"], ["s", "n"]), ["k"]).first()
    assert (none["passed"], none["diff_count"], none["diffs"], none["truncated"]) == (True, 0, [], False)


def test_finalise(spark):
    phases = spark.createDataFrame(
        [("a", "validate", "validated"), ("b", "validate", "no_input"), ("c", "check", "new_data")],
        "run_id string, phase string, status string",
    )
    got = {r["run_id"]: (r["status"], r["validacao"]) for r in QA.finalise(phases).collect()}
    assert got == {"a": ("success", "validated"), "b": ("failed", "no_input"), "c": ("failed", "unknown")}


def test_catalog_evolution(spark):
    import uuid

    name, path = f"t_{uuid.uuid4().hex[:8]}", fresh_path(spark, "t")
    df = spark.createDataFrame([(1, 2024), (2, 2023)], "x int, ano int")
    df.write.partitionBy("ano").parquet(path)
    ST.create_external(spark, name, path, S._schema("x int, ano int"), ["ano"])
    assert TB.register_partitions(spark, name, df.where("ano = 2024"), ["ano"]) == 1
    assert spark.table(name).count() == 1
    TB.discover_partitions(spark, name)
    TB.add_columns(spark, name, {"wape": "double", "x": "int"})
    odd = spark.createDataFrame([(1, "it's"), (2, "a\\b"), (3, None)], "x int, seg string")
    odd.write.partitionBy("seg").parquet(f"{path}-odd")
    ST.create_external(spark, f"{name}_odd", f"{path}-odd", S._schema("x int, seg string"), ["seg"])
    assert TB.register_partitions(spark, f"{name}_odd", odd, ["seg"]) == 3
    assert spark.table(f"{name}_odd").where("seg = \"it's\"").count() == 1
    assert rows(spark.table(name).select("x", "ano")) == [(1, 2024), (2, 2023)]
    assert spark.table(name).where("wape IS NOT NULL").isEmpty()


def put(spark, root, name, columns, *lines):
    text = spark.createDataFrame([(x,) for x in [",".join(columns), *lines]], "value string").coalesce(1)
    text.write.text(f"{root}/{name}")


def test_csv_is_bound_by_name(spark):
    root = fresh_path(spark, "csv")
    put(spark, root, "a.csv", ["B", "a"], "2,x", "oops,y", ",z")
    put(spark, root, "b.csv", ["a", "more"], "w,1")
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])
    got = SB.read_by_name(spark, [f"{root}/a.csv", f"{root}/b.csv"], schema)
    assert rows(got.fillna(-1), "a", "b", "_unparsed") == [("w", -1, 0), ("x", 2, 0), ("y", -1, 1), ("z", -1, 0)]
    assert SB.read_csv(spark, f"{root}/a.csv", schema).columns == ["a", "b"]


@pytest.mark.parametrize("files_per_batch", [1, None])
def test_ingest_neither_loses_nor_ages_rows(spark, files_per_batch):
    root = fresh_path(spark, "ingest")
    put(spark, root, "in/a.csv", ["idade", "data_referencia", "cliente_id"], "99,2024-02-29,A", "98,2024-02-29,B", "1,,C", "2,2024-03-31,")
    time.sleep(0.05)
    put(spark, root, "in/b.csv", ["cliente_id", "idade", "data_referencia"], "A,20,2024-02-29", "D,old,2024-02-29")
    IN.replay(spark, f"{root}/in", f"{root}/panel", f"{root}/cp", f"{root}/ledger", files_per_batch, suffix="")
    panel = IN.read_panel(spark, f"{root}/panel")
    assert rows(panel, "cliente_id", "idade", "ano", "mes", "trimestre") == [("A", 20, 2024, 2, 1), ("B", 98, 2024, 2, 1)]
    assert spark.read.parquet(f"{root}/panel-rejects").count() == 3
    assert LG.latest_versions(LG.read_ingest_ledger(spark, f"{root}/ledger")).count() >= 2


def test_an_empty_source_leaves_the_panel(spark, lab):
    from tidecast import jobs

    cfg = jobs.Config(root=fresh_path(spark, "guard"))
    TB.replace_panel(lab.panel, cfg.panel)
    b = lab.bank
    empty = type(b)(b.customers, b.accounts, b.loans, b.branches, b.transactions.where("false"))
    with pytest.raises(ValueError):
        jobs.build_panel(spark, empty, cfg, "2024-05-31")
    assert IN.read_panel(spark, cfg.panel).count() == lab.panel.count()


def test_files_may_come_in_any_order(spark):
    root = fresh_path(spark, "order")
    for name, age in (("a", 30), ("b", 40), ("c", 50)):
        put(spark, root, f"in/{name}.csv", ["cliente_id", "idade", "data_referencia"], f"A,{age},2024-02-29", f"{name},1,2024-02-29")
        time.sleep(0.05)
    got = {}
    for order in itertools.permutations("abc"):
        path = f"{root}/panel-{''.join(order)}"
        for i, name in enumerate([*order, order[0]]):  # the first file comes once more
            keys = [r["key"] for r in ST.list_files(spark, f"{root}/in", "").where(F.col("key").contains(f"/{name}.csv/")).select("key").collect()]
            assert keys
            IN.ingest_batch(spark, ST.read_incoming(spark, keys, S.PANEL), path, f"r{i}")
        got[order] = rows(IN.read_panel(spark, path), "cliente_id", "idade")
    assert set(map(str, got.values())) == {str([("A", 50), ("a", 1), ("b", 1), ("c", 1)])}


def test_readers_see_whole_versions(spark):
    from tidecast.sinks import snapshots as SN

    path = fresh_path(spark, "versions")
    assert IN.read_panel(spark, path).count() == 0
    TB.replace_panel(panel_rows(spark, 5, [1, 2]), path)
    before = IN.read_panel(spark, path)
    broken = panel_rows(spark, 9, [1]).withColumn("saldo_m1", F.expr("CASE WHEN saldo_m1 > 3 THEN raise_error('lost') ELSE saldo_m1 END").cast("double"))
    with pytest.raises(Exception, match="lost"):
        TB.replace_panel(broken, path)
    assert IN.read_panel(spark, path).count() == before.count() == 10
    TB.replace_panel(panel_rows(spark, 7, [3]), path)
    assert (before.count(), IN.read_panel(spark, path).count()) == (10, 7)
    IN.merge_into_panel(spark, panel_rows(spark, 2, [4]), path)
    assert (before.count(), IN.read_panel(spark, path).count()) == (10, 9)
    TB.replace_panel(panel_rows(spark, 1, [3]), path)
    assert len(SN.versions(spark, path)) == 3 and SN.retire(spark, path) == 1
    assert len(SN.versions(spark, path)) == 2 and IN.read_panel(spark, path).count() == 1
