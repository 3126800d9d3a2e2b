"""Registered queries: a Spark function over a data folder and, where SQL can say it, the twin."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recontact.checks.sample import sample_warehouse, with_views
from recontact.sources.warehouse import Warehouse

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, run: Callable[[Warehouse], DataFrame], sql: str | None = None) -> None:
    """``run`` takes the derived warehouse; ``sql`` reads the same tables and views."""
    if name in QUERIES:
        raise ValueError(f"query {name!r} is registered twice")
    QUERIES[name] = lambda spark, sf_dir: run(sample_warehouse(spark, sf_dir))
    if sql is not None:
        ORACLE[name] = with_views(sql)


def ledger_columns(df: DataFrame) -> DataFrame:
    """All 16 ledger columns; the two decimals as whole numbers, as both engines print them alike."""
    return df.withColumns({c: F.col(c).cast("int") for c in ("reached_patient_flag", "opt_out")})


def numbered_sql(
    ctes: str,
    chosen: str,
    client: str,
    voucher: str,
    patient: str = "NULL",
    app_state: str = "NULL",
    korb: str = "NULL",
    language: str = "NULL",
    key: Sequence[str] = ("case_id",),
    new_batch: int = 1,
    empty_ledger: bool = False,
) -> str:
    """SQL that numbers the rows of ``chosen`` after the ledger, in the order of the library."""
    last_id, last_batch = (
        "0" if empty_ledger else f"(SELECT coalesce(max({n}), 0) FROM cam_select)" for n in ("select_id", "batch_id")
    )
    order = f"md5(concat_ws('|', {', '.join(key)})), " + ", ".join(f"{k} NULLS LAST" for k in key)
    prefix = f"WITH {ctes} " if ctes.strip() else ""
    return f"""{prefix}
SELECT {last_id} + row_number() OVER (ORDER BY {order}) AS select_id,
  cast({last_batch} + {new_batch} AS bigint) AS batch_id, case_id,
  {client} AS client_name, {voucher} AS first_voucher_code, cast({patient} AS string) AS patient_id,
  0 AS control_flag, 1 AS count_cases_patient, cast({app_state} AS string) AS app_state,
  cast({korb} AS string) AS korb, cast({language} AS string) AS preferred_language,
  cast(NULL AS int) AS reached_patient_flag, cast(NULL AS date) AS reached_date, cast(NULL AS string) AS refusal_reason,
  cast(NULL AS int) AS opt_out, cast(NULL AS string) AS new_case_id
FROM {chosen}"""
