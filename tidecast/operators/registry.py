"""Champion gate, its replay over the run history and the as-of champion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tidecast import schemas as S
from tidecast.operators.prefix import last_before

# Promotion rules and reason words.
MIN_WAPE_GAIN_PP = 1.0
MAX_R2_LOSS = 0.01
TOLERANCE = 1e-9
FIRST, PASSED = "primeiro_champion", "criterios_atendidos"


def fails(new: dict[str, Column], champ: dict[str, Column]) -> list[tuple[str, Column]]:
    """Rules in checking order; each condition is true when the candidate fails it."""
    return [
        ("wape", new["wape"] > champ["wape"] - MIN_WAPE_GAIN_PP + TOLERANCE),
        ("r2", new["r2"] < champ["r2"] - MAX_R2_LOSS - TOLERANCE),
        ("total_linhas", new["total_linhas"] < champ["total_linhas"]),
    ]


def gate_reason(new: dict[str, Column], champ: dict[str, Column]) -> Column:
    """Reason of promotion, or the name of the first rule that fails."""
    reason = F.lit(PASSED)
    for name, bad in reversed(fails(new, champ)):
        reason = F.when(bad, F.lit(name)).otherwise(reason)
    return F.when(champ["wape"].isNull(), F.lit(FIRST)).otherwise(reason)


def gate_detail(new: dict[str, Column], champ: dict[str, Column]) -> Column:
    """Each rule with the run's figure, the bound it had to keep and the champion's figure."""
    bounds = {
        "wape": ("<=", champ["wape"] - MIN_WAPE_GAIN_PP),
        "r2": (">=", champ["r2"] - MAX_R2_LOSS),
        "total_linhas": (">=", champ["total_linhas"]),
    }
    shown = lambda c, n: c.cast("bigint").cast("string") if n == "total_linhas" else c.cast("decimal(38,4)").cast("string")
    parts = [
        F.concat(F.lit(f"{n} "), F.coalesce(shown(new[n], n), F.lit("-")), F.lit(f" {op} "), shown(bound, n), F.lit(" ("), shown(champ[n], n), F.lit(")"))
        for n, (op, bound) in bounds.items()
    ]
    return F.when(champ["wape"].isNotNull(), F.concat_ws("; ", *parts))


def promoted(reason: Column) -> Column:
    return reason.isin(FIRST, PASSED)


def evaluate(pairs: DataFrame) -> DataFrame:
    """Gate over rows with ``wape, r2, total_linhas`` and the same with ``champion_``."""
    names = ["wape", "r2", "total_linhas"]
    new = {n: F.col(n) for n in names}
    champ = {n: F.col(f"champion_{n}") for n in names}
    reason = gate_reason(new, champ)
    return (
        pairs.withColumn("promotion_reason", reason)
        .withColumn("promotion_detail", gate_detail(new, champ))
        .withColumn("promoted", promoted(F.col("promotion_reason")))
    )


LOG_COLUMNS = ["dt_processamento", "run_id", "modelo_versao", "rmse", "wape", "mape", "r2", "total_linhas"]


def promotions(runs: DataFrame) -> list[Row]:
    """Promoted runs in time order.

    The gate is stateful, but a champion only gives way to the first later run
    that passes against it. Each step asks the stored log for that one row.
    Every promotion lowers WAPE by a full point, so the steps are few however
    long the log is.
    """
    at = F.struct("dt_processamento", "run_id")
    names = ["wape", "r2", "total_linhas"]
    new = {n: F.col(n) for n in names}
    found: list[Row] = []
    while True:
        if found:
            last = found[-1]
            champ = {n: F.lit(last[n]).cast(runs.schema[n].dataType) for n in names}
            after = at > F.struct(F.lit(last["dt_processamento"]), F.lit(last["run_id"]))
            later = runs.where(after & promoted(gate_reason(new, champ)))
        else:
            later = runs
        step = later.agg(F.min_by(F.struct(*LOG_COLUMNS), at).alias("r")).first()["r"]
        if step is None:
            return found
        found.append(step)


def replay_champions(runs: DataFrame) -> DataFrame:
    """Run history with ``is_champion`` and the champion that stands after each run.

    Expects a stored run log. The few promotions enter as literals, so each row
    finds its champion without a join or a window.
    """
    won = promotions(runs)
    key = F.struct("dt_processamento", "run_id")
    kinds = {c: runs.schema[c].dataType for c in LOG_COLUMNS}
    steps = [F.struct(*[F.lit(r[c]).cast(kinds[c]).alias(c) for c in LOG_COLUMNS]) for r in won]
    standing = F.lit(None)
    for r, step in zip(won, steps):
        reached = key >= F.struct(F.lit(r["dt_processamento"]), F.lit(r["run_id"]))
        standing = F.when(reached, step).otherwise(standing)
    marked = runs.withColumn("_c", standing) if won else runs
    return marked.select(
        *runs.columns,
        F.col("run_id").isin([r["run_id"] for r in won]).alias("is_champion"),
        *[
            (F.col("_c").getField(c) if won else F.lit(None).cast(kinds[c])).alias(f"champion_{c}")
            for c in ("modelo_versao", "rmse", "wape", "mape")
        ],
    ).select(*S.METRICS.fieldNames())


def gate_history(metrics: DataFrame) -> DataFrame:
    """Each run against the champion that stood before it, with the reason."""
    before = Window.orderBy("dt_processamento", "run_id").rowsBetween(Window.unboundedPreceding, -1)

    def standing(c: str) -> Column:
        return F.last(F.when(F.col("is_champion"), F.col(c)), ignorenulls=True).over(before)

    pairs = metrics.select(
        "run_id",
        "dt_processamento",
        "wape",
        "r2",
        "total_linhas",
        *[standing(c).alias(f"champion_{c}") for c in ("wape", "r2", "total_linhas")],
    )
    return evaluate(pairs)


def champion_history(metrics: DataFrame) -> DataFrame:
    """Promotions with the span in which each one was live."""
    w = Window.orderBy("dt_processamento", "run_id")
    return metrics.where("is_champion").select(
        "run_id",
        "modelo_versao",
        "wape",
        "r2",
        "total_linhas",
        F.col("dt_processamento").alias("promoted_at"),
        F.lead("dt_processamento").over(w).alias("replaced_at"),
    )


def current_champion(metrics: DataFrame) -> DataFrame:
    """Latest promotion, or no row."""
    return (
        metrics.where("is_champion")
        .orderBy(F.desc("dt_processamento"), F.desc("run_id"))
        .limit(1)
    )


def champion_as_of(instants: DataFrame, at: str, history: DataFrame) -> DataFrame:
    """Champion live at each instant, without a range join.

    Instants are first made distinct, merged with the promotions into one time
    line, and the last promotion seen is carried forward along sampled ranges of
    it, so there may be as many instants as facts. Facts then join on equality
    with the result.
    """
    line = (
        instants.select(F.col(at).alias("t"))
        .distinct()
        .select("t", F.lit(1).alias("k"), F.lit(None).cast("string").alias("champion_run_id"))
        .unionByName(
            history.select(
                F.col("promoted_at").alias("t"), F.lit(0).alias("k"), F.col("run_id").alias("champion_run_id")
            )
        )
    )
    order = [F.col("t"), F.col("k"), F.col("champion_run_id")]
    carried = last_before(line, order, F.col("champion_run_id"), "live")
    return carried.where("k = 1").select(F.col("t").alias(at), F.col("live").alias("champion_run_id"))
