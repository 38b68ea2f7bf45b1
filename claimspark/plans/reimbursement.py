"""Job: charge notices -> reimbursements."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame

from claimspark.operators import reimburse as r
from claimspark.schemas import schema
from claimspark.session import Run, staged
from claimspark.sources.keyed import KeyedTable
from claimspark.sources.keys import assign_ids
from claimspark.sources.sequences import Sequence
from claimspark.sources.tables import append

# Loop order of the job: by beneficiary number, then attendance; place breaks ties.
ORDER = ["cd_ressarcimento_sus", "cd_cco", "nr_atendimento", "nm_municipio", "cd_uf", "nm_ups"]
DENIAL_ORDER = ["cd_reembolso", "cd_procedimento", "cd_cco"]
# Names of the sequences: fixed values.
HEADS, DENIALS = "seq_reembolso", "seq_itreembolso_glosa"

Stage = Callable[[DataFrame], DataFrame]
Start = int | Callable[[int], int]


def heads_of(rows: DataFrame, members: DataFrame, depara: DataFrame, as_of: date, user: str | None, tenant: int | None) -> DataFrame:
    """Reimbursement heads without ids, from the open notices' validated items."""
    summary = r.summary_of(rows)
    texts = r.critique_text(r.critiques_of(rows, depara, as_of))
    return r.reimbursement_header(summary, r.resolve_members(r.asked_members(rows), members), texts, as_of, user, tenant)


def draft(items: DataFrame, val: DataFrame, notices: DataFrame, reemb: DataFrame, members: DataFrame,
          depara: DataFrame, as_of: date, user: str | None, tenant: int | None,
          only_confirmed: bool = True, stage: Stage = staged) -> DataFrame:
    """Reimbursement heads without ids."""
    return heads_of(stage(r.open_rows(items, val, notices, reemb, only_confirmed)), members, depara, as_of, user, tenant)


def generate_reimbursements(items: DataFrame, val: DataFrame, notices: DataFrame, reemb: DataFrame,
                            members: DataFrame, depara: DataFrame, as_of: date, user: str | None,
                            tenant: int | None, only_confirmed: bool = True, start_id: Start = 1,
                            stage: Stage = staged) -> dict[str, DataFrame]:
    """Heads with ids, their items and denials, and the items linked back.

    The validated items of the open notices are kept by ``stage`` and read for summary, items and critiques, so the items
    are scanned once for them (and once more to be linked back). Denials carry no id yet: number them when they
    are written.
    """
    rows = stage(r.open_rows(items, val, notices, reemb, only_confirmed))
    heads = assign_ids(heads_of(rows, members, depara, as_of, user, tenant), ORDER, start_id, "cd_reembolso", stage)
    lines = stage(r.reimbursement_items(heads, r.items_of(rows, depara, as_of), user))
    return {
        "reimbursement": heads,
        "reimbursement_item": lines,
        "reimbursement_denial": r.reimbursement_denials(lines, as_of),
        "item": r.back_link(items, heads),
    }


def write_reimbursements(frames: dict[str, DataFrame], base: str, batch: str, first_denial: Start = 1,
                         items: KeyedTable | None = None, stage: Stage | None = None) -> None:
    """Append the job's rows to the result tables and write the links back to the items.

    With a keyed table of items (by notice) only its files that hold a notice of the batch are written anew;
    without one the linked items are written as a new table.
    """
    append(frames["reimbursement"].select(*schema("reimbursement").fieldNames()), f"{base}/reimbursement", batch)
    append(
        frames["reimbursement_item"].select(*schema("reimbursement_item").fieldNames()),
        f"{base}/reimbursement_item",
        batch,
    )
    denials = assign_ids(frames["reimbursement_denial"], DENIAL_ORDER, first_denial, "cd_itreembolso_glosa", stage)
    append(denials.select(*schema("reimbursement_denial").fieldNames()), f"{base}/reimbursement_denial", batch)
    if items is None:
        frames["item"].write.mode("overwrite").parquet(f"{base}/item_{batch}")
    else:
        heads = frames["reimbursement"]
        items.rewrite(heads.select(r.NOTICE), lambda rows: r.back_link(rows, heads))


def reimburse(items: KeyedTable, val: DataFrame, notices: DataFrame, reemb: DataFrame, members: DataFrame,
              depara: DataFrame, base: str, batch: str, as_of: date, user: str | None, tenant: int | None) -> None:
    """One batch from the stored items to the stored reimbursements, ids from the sequences below ``base``.

    ``items`` is keyed by notice. The batch's own frames go when its results are written. A batch that is run again
    replaces its rows under the same ids; its own rows must not be in ``reemb`` then.
    """
    spark = val.sparkSession
    with Run(spark) as run:
        numbers = {name: Sequence(spark, base, name) for name in (HEADS, DENIALS)}
        out = generate_reimbursements(
            items.read(), val, notices, reemb, members, depara, as_of, user, tenant,
            start_id=lambda n: numbers[HEADS].lease(n, batch), stage=run.keep,
        )
        write_reimbursements(out, base, batch, lambda n: numbers[DENIALS].lease(n, batch), items, run.keep)
