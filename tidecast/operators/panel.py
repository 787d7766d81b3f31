"""Monthly customer panel from raw bank tables.

Plan shape: transactions are summed to account-months before any join (map-side
combine shrinks a hot account to its months), account-months are accumulated
per account, summed to customer-months, and every per-customer window runs on
one partitioning by customer. Windows see at most one row per month and key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidecast import schemas as S
from tidecast.functions import calendar as C
from tidecast.functions import money as M
from tidecast.functions import recode as R
from tidecast.operators.prefix import running_sum
from tidecast.sources.bank import Bank

COMPLETED = "completed"
INCOME_FACTOR, INCOME_RANGE, INCOME_DEFAULT = 1.25, (1000, 50000), 3000
MIN_MONTHS = 6


def keep_status(tx: DataFrame, status: str | None = COMPLETED) -> DataFrame:
    """Filter on the status; skipped when blank or when there is no such column."""
    if status and "status" in tx.columns:
        return tx.where(F.col("status") == status)
    return tx


def account_owners(accounts: DataFrame) -> DataFrame:
    """Owner and opening balance of each account."""
    return accounts.select(
        "account_id", "customer_id", M.opening_balance("balance").alias("saldo_abertura")
    )


def signed_transactions(tx: DataFrame, accounts: DataFrame, status: str | None = COMPLETED) -> DataFrame:
    """Transactions with owner, signed amount and credit/debit split."""
    return (
        keep_status(tx, status)
        .join(account_owners(accounts), "account_id")
        .withColumns(
            {
                "signed": M.signed_amount(),
                "valor_creditos": M.amount_of_types(M.CREDIT_TYPES),
                "valor_debitos": M.amount_of_types(M.DEBIT_TYPES),
            }
        )
    )


def running_balance(
    tx: DataFrame,
    accounts: DataFrame,
    status: str | None = COMPLETED,
) -> DataFrame:
    """Balance after every transaction, in date and id order."""
    run = running_sum(
        keep_status(tx, status).withColumn("signed", M.signed_amount()),
        keys=["account_id"],
        order_by=[F.col("transaction_date"), F.col("transaction_id")],
        value=M.units("signed"),
        out="_mov",
    ).join(account_owners(accounts), "account_id")
    balance = F.col("_mov") + M.units("saldo_abertura")
    return run.withColumn("balance", M.from_units(balance)).drop("_mov")


def account_months(tx: DataFrame, accounts: DataFrame, status: str | None = COMPLETED) -> DataFrame:
    """Last balance, credits, debits and count per account and active month, in money units."""
    sums = (
        keep_status(tx, status)
        .groupBy("account_id", C.month_start("transaction_date").alias("period"))
        .agg(
            F.sum(M.units(M.signed_amount())).alias("_mov"),
            F.sum(M.units(M.amount_of_types(M.CREDIT_TYPES))).alias("_cred"),
            F.sum(M.units(M.amount_of_types(M.DEBIT_TYPES))).alias("_deb"),
            F.count("transaction_id").alias("qtd_transacoes_mes"),
        )
    )
    w = Window.partitionBy("account_id").orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    # the window comes first: its sort on (account, period) also serves the join
    run = sums.withColumn("_run", F.sum("_mov").over(w)).drop("_mov")
    return run.join(account_owners(accounts), "account_id").select(
        "customer_id",
        "account_id",
        "period",
        (F.col("_run") + M.units("saldo_abertura")).alias("_saldo"),
        "_cred",
        "_deb",
        "qtd_transacoes_mes",
    )


def account_month_report(tx: DataFrame, accounts: DataFrame, status: str | None = COMPLETED) -> DataFrame:
    return account_months(tx, accounts, status).select(
        "customer_id",
        "account_id",
        "period",
        M.from_units("_saldo").alias("saldo_conta"),
        M.from_units("_cred").alias("valor_creditos_mes"),
        M.from_units("_deb").alias("valor_debitos_mes"),
        "qtd_transacoes_mes",
    )


def customer_months(tx: DataFrame, accounts: DataFrame, status: str | None = COMPLETED) -> DataFrame:
    """Sum over the accounts active in the month; idle accounts add nothing."""
    return (
        account_months(tx, accounts, status)
        .groupBy("customer_id", "period")
        .agg(
            M.from_units(F.sum("_saldo")).alias("saldo_raw"),
            M.from_units(F.sum("_cred")).alias("valor_creditos_mes"),
            M.from_units(F.sum("_deb")).alias("valor_debitos_mes"),
            F.sum("qtd_transacoes_mes").alias("qtd_transacoes_mes"),
        )
    )


def with_lags(months: DataFrame) -> DataFrame:
    """Balance of the current and the five previous active months."""
    w = Window.partitionBy("customer_id").orderBy("period")
    return months.withColumns(
        {name: F.lag("saldo_raw", k).over(w) if k else F.col("saldo_raw") for k, name in enumerate(S.LAGS)}
    )


def complete_lags(months: DataFrame) -> DataFrame:
    return months.dropna(subset=S.LAGS)


def with_history(panel: DataFrame, key: str = "customer_id", min_months: int = MIN_MONTHS) -> DataFrame:
    """Customers with at least ``min_months`` panel rows, by a window instead of a self-join."""
    if min_months <= 1:
        return panel
    w = Window.partitionBy(key)
    return (
        panel.withColumn("_n", F.count(F.lit(1)).over(w)).where(F.col("_n") >= min_months).drop("_n")
    )


def income_estimate(median_credits: Column) -> Column:
    """Clipped multiple of the median credits, in cents; a half cent goes to the even one."""
    base = F.coalesce(median_credits, F.lit(INCOME_DEFAULT).cast("double"))
    return F.rint(M.clip(base * INCOME_FACTOR, *map(float, INCOME_RANGE)) * 100) / 100


def first_customers(bank: Bank, n: int) -> Bank:
    """Restrict customers, accounts and (through them) transactions to the first n ids."""
    keep = bank.customers.select("customer_id").distinct().orderBy("customer_id").limit(n)
    accounts = bank.accounts.join(keep, "customer_id", "left_semi")
    return Bank(
        customers=bank.customers.join(keep, "customer_id", "left_semi"),
        accounts=accounts,
        loans=bank.loans,
        branches=bank.branches,
        transactions=bank.transactions.join(accounts, "account_id", "left_semi"),
    )


def active_accounts(accounts: DataFrame) -> DataFrame:
    return (
        accounts.where(F.col("account_status") == "active")
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).cast("int").alias("qtd_produtos_ativos"))
    )


def active_loans(loans: DataFrame) -> DataFrame:
    return (
        loans.where(F.col("loan_status") == "active")
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).cast("int").alias("qtd_emprestimos"))
    )


def branch_cities(branches: DataFrame) -> DataFrame:
    """One city per branch, so the left join cannot multiply customers."""
    return branches.groupBy("branch_code").agg(F.min("city").alias("city"))


def customer_profile(bank: Bank, as_of: Column) -> DataFrame:
    """One row per customer with all profile columns but income."""
    cols = ["dob", "gender", "account_open_date", "customer_segment", "branch_code"]
    one = (
        bank.customers.groupBy("customer_id")
        .agg(F.min(F.struct(*cols)).alias("c"))
        .select("customer_id", "c.*")
    )
    seg = F.col("segmento")
    return (
        one.join(active_accounts(bank.accounts), "customer_id", "left")
        .join(active_loans(bank.loans), "customer_id", "left")
        .join(branch_cities(bank.branches), "branch_code", "left")
        .withColumn("segmento", R.segment())
        .select(
            F.col("customer_id").alias("cliente_id"),
            C.age_years(as_of).alias("idade"),
            "segmento",
            C.tenure_months(as_of).alias("tempo_relacionamento"),
            R.state().alias("uf"),
            R.gender_letter().alias("genero"),
            (seg == "PRIVATE").cast("int").alias("possui_investimento"),
            (F.coalesce("qtd_emprestimos", F.lit(0)) > 0).cast("int").alias("possui_credito"),
            seg.isin("PRIME", "PRIVATE").cast("int").alias("possui_seguro"),
            R.score().cast("int").alias("score_credito"),
            F.coalesce("qtd_produtos_ativos", F.lit(1)).alias("qtd_produtos_ativos"),
        )
    )


def monthly_panel(
    bank: Bank,
    as_of: Column | str,
    status: str | None = COMPLETED,
    min_months: int = MIN_MONTHS,
    max_customers: int | None = None,
) -> DataFrame:
    """The 27-column panel.

    ``as_of`` dates the ages and tenures. Income is the median over all panel
    months of the customer, later ones included. The default minimum of six
    panel rows comes on top of the five months spent on lags.
    """
    as_of = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    if max_customers:
        bank = first_customers(bank, max_customers)
    months = complete_lags(with_lags(customer_months(bank.transactions, bank.accounts, status)))
    per_customer = Window.partitionBy("customer_id")
    months = months.withColumn(
        "renda_mensal", income_estimate(F.median("valor_creditos_mes").over(per_customer))
    )
    months = C.with_calendar(with_history(months, min_months=min_months))
    months = months.withColumnRenamed("customer_id", "cliente_id").drop("period", "saldo_raw")
    profile = customer_profile(bank, as_of)
    return months.join(profile, "cliente_id", "left").select(
        *[F.col(f.name).cast(f.dataType) for f in S.PANEL]
    )


def month_slice(panel: DataFrame, month: str) -> DataFrame:
    """Rows of one ``YYYY-MM``; a date range, so partition and row-group pruning apply."""
    first = F.lit(f"{month}-01").cast("date")
    return panel.where(
        (F.col("data_referencia") >= first) & (F.col("data_referencia") < F.add_months(first, 1))
    )


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"no rows: {what}")
    return df


def split_at_month(panel: DataFrame, month: str) -> tuple[DataFrame, DataFrame]:
    """History before the month and the batch of the month; later months are in neither."""
    first = F.lit(f"{month}-01").cast("date")
    return panel.where(F.col("data_referencia") < first), month_slice(panel, month)


def months_of(panel: DataFrame) -> DataFrame:
    return panel.groupBy(C.month_key("data_referencia").alias("mes_ref")).agg(
        F.count(F.lit(1)).alias("linhas")
    )


def cutoff_month(panel: DataFrame, index: int = -3) -> DataFrame:
    """One-row frame with the month at ``index`` of the sorted months, at least the second one."""
    w = Window.orderBy("mes_ref")
    ranked = months_of(panel).select(
        "mes_ref",
        (F.row_number().over(w) - 1).alias("pos"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("n"),
    )
    at = F.greatest(F.lit(1), F.col("n") + index) if index < 0 else F.lit(index)
    return ranked.where(F.col("pos") == at).select("mes_ref", "pos", "n")
