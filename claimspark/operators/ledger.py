"""Ledger account names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.operators.picks import look_up

FIXED_CODE = "1.2.1"
NOT_FOUND = "NAO ENCONTRADO"


def closed_accounts(chart: DataFrame, closed_months: DataFrame, tenant: int, code: str) -> DataFrame:
    """Accounts of the tenant's charts with the periods (first day of the year, month) that each chart was closed for."""
    periods = closed_months.filter(F.col("cd_multi_empresa") == tenant).select(
        "cd_plano", F.trunc("dt_ano", "year").alias("dt_exercicio"), "dt_mes"
    )
    # a chart closed twice for a period counts once
    return chart.filter(F.col("cd_contabil") == code).join(periods.distinct(), "cd_plano")


def account_name(requests: DataFrame, chart: DataFrame, closed_months: DataFrame, ledger: DataFrame, tenant: int,
                 fixed_code: str = FIXED_CODE) -> DataFrame:
    """Account name by code or short code: the chart closed for the request's month first, then the current one.

    The closed chart's lookup reads one fixed account code only. An account found there
    without a name is not looked up again.
    """
    year, month = F.trunc("dt_referencia", "year"), F.date_format("dt_referencia", "MM")
    closed = closed_accounts(chart, closed_months, tenant, fixed_code)
    closed_key = [F.col("dt_exercicio"), F.col("dt_mes")]
    in_year = look_up(
        requests,
        closed,
        [
            ([year, month, F.col("cd_contabil")], [*closed_key, F.col("cd_contabil")]),
            ([year, month, F.col("cd_reduzido")], [*closed_key, F.col("cd_reduzido")]),
        ],
        F.struct("cd_plano", "cd_reduzido", "ds_conta"),
        "_closed",
        "_closed_hi",
    )
    current = look_up(
        in_year,
        ledger.filter(F.col("cd_multi_empresa") == tenant),
        [
            ([F.col("cd_contabil")], [F.col("cd_contabil")]),
            ([F.col("cd_reduzido")], [F.col("cd_reduzido")]),
        ],
        F.struct("cd_reduzido", "ds_conta"),
        "_now",
        "_now_hi",
    )
    name = F.when(F.col("_closed").isNotNull(), F.col("_closed.ds_conta")).otherwise(F.col("_now.ds_conta"))
    return current.select(*requests.columns, F.coalesce(name, F.lit(NOT_FOUND)).alias("ds_conta"))
