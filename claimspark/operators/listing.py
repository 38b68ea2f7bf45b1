"""Screen queries over notices. ``notice`` narrows a listing to one notice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.functions import joined
from claimspark.operators.reimburse import NOTICE, member_key, with_cco
from claimspark.sources.tables import ITEM

# Columns of the item listing in screen order: fixed values.
ITEM_LISTING = [
    ITEM, "cd_ressarcimento_sus_anexo", "nm_ups", "nm_municipio", "cd_uf", "nr_competencia", "tp_atendimento",
    "nr_atendimento", "dt_inicio", "dt_fim", "cd_carater", "cd_matricula", "cd_mat_alternativa", "nm_segurado",
    "cd_beneficiario", "cd_cco", "dt_nasc_beneficiario", "cd_procedimento", "ds_procedimento", "vl_procedimento",
    "ds_atendimento", "vl_total", "cd_ressarcimento_sus", "cd_reembolso", "tp_validacao", "sn_confirmar",
    "tp_procedimento",
]


def _of_notice(df: DataFrame, notice: int | None) -> DataFrame:
    return df if notice is None else df.filter(F.col(NOTICE) == notice)


def item_listing(items: DataFrame, members: DataFrame, val: DataFrame, notice: int | None = None) -> DataFrame:
    """Items with member and validation type, each combination once, by item id.

    The item id is the table's key, so taking the distinct members and validation
    types before the joins gives distinct rows without shuffling the wide rows again.
    """
    pair = ["cd_cco_base", "nr_div_cco"]
    people = member_key(members).select(*pair, "cd_matricula", "cd_mat_alternativa", "nm_segurado").distinct()
    types = val.select(ITEM, "tp_validacao").distinct()
    rows = with_cco(_of_notice(items, notice)).join(people, pair, "left").join(types, ITEM, "left")
    return (
        rows.withColumn("cd_cco", joined(F.col("cd_cco_base"), F.col("nr_div_cco"))).select(*ITEM_LISTING).orderBy(ITEM)
    )


def validation_listing(val: DataFrame, items: DataFrame, notices: DataFrame, notice: int | None = None) -> DataFrame:
    """Validations of the notices' items, with the type spelled out."""
    listed = _of_notice(items.select(ITEM, NOTICE), notice).join(notices.select(NOTICE), NOTICE, "left_semi")
    label = (
        F.when(F.col("tp_validacao") == "A", "AUTORIZADO")
        .when(F.col("tp_validacao") == "I", "IMPUGNADO")
        .when(F.col("tp_validacao") == "E", "ERRO")
    )
    return val.join(listed, ITEM, "left_semi").withColumn("ds_validacao", label)


def notice_list(notices: DataFrame, tenant: int) -> DataFrame:
    """Notices of the tenant, newest first."""
    return notices.filter(F.col("cd_multi_empresa") == tenant).orderBy(F.desc(NOTICE))


def attachments(notices: DataFrame, attach: DataFrame, notice: int | None = None) -> DataFrame:
    """Attached files of the notices, by file id."""
    return attach.join(_of_notice(notices.select(NOTICE), notice), NOTICE).orderBy("cd_ressarcimento_sus_anexo")


def history(notices: DataFrame, hist: DataFrame, notice: int | None = None) -> DataFrame:
    """Notes of the notices."""
    return hist.join(_of_notice(notices.select(NOTICE), notice), NOTICE)


def active_values(df: DataFrame, code: str, label: str) -> DataFrame:
    """Pick list of the rows marked active."""
    return df.filter(F.col("sn_ativo") == "S").select(code, label)


def status_totals(reemb: DataFrame, reemb_items: DataFrame) -> DataFrame:
    """Count, charged, payable and denied value per notice, overall and by status E/C/N.

    Inferred from the screen's columns: charged = vl_cobrado, payable =
    vl_procedimento, denied = their difference. Items are summed per reimbursement
    first, so the counts need no distinct.
    """
    money0 = F.lit(0).cast("decimal(18,2)")
    per = reemb_items.groupBy("cd_reembolso").agg(
        F.sum("vl_cobrado").alias("cobrado"), F.sum("vl_procedimento").alias("pagar")
    )
    rows = reemb.join(per, "cd_reembolso", "left").select(
        NOTICE,
        "tp_status",
        F.coalesce("cobrado", money0).alias("cobrado"),
        F.coalesce("pagar", money0).alias("pagar"),
    )
    aggs = []
    for tag, hit in [("", F.lit(True)), *[(f"_{s.lower()}", F.col("tp_status") == s) for s in ("E", "C", "N")]]:
        def total(c, hit=hit):
            return F.coalesce(F.sum(F.when(hit, c)), money0).cast("decimal(18,2)")

        aggs += [
            F.count(F.when(hit, 1)).alias(f"nr_reembolsos{tag}"),
            total(F.col("cobrado")).alias(f"vl_cobrado{tag}"),
            total(F.col("pagar")).alias(f"vl_pagar{tag}"),
            total(F.col("cobrado") - F.col("pagar")).alias(f"vl_glosado{tag}"),
        ]
    return rows.groupBy(NOTICE).agg(*aggs)


def attendance_total(items: DataFrame) -> DataFrame:
    """Value of all items per notice (inferred from the screen's total)."""
    return items.groupBy(NOTICE).agg(F.sum("vl_procedimento").cast("decimal(18,2)").alias("vl_atendimentos"))


def item_severity(val: DataFrame) -> DataFrame:
    """Worst validation of an item: ERRO over IMPUGNADO over AUTORIZADO (inferred from the colour key)."""
    rank = (
        F.when(F.col("tp_validacao") == "E", 3)
        .when(F.col("tp_validacao") == "I", 2)
        .when(F.col("tp_validacao") == "A", 1)
    )
    worst = val.groupBy(ITEM).agg(F.max(rank).alias("nr_gravidade"))
    colour = (
        F.when(F.col("nr_gravidade") == 3, "VERMELHO")
        .when(F.col("nr_gravidade") == 2, "AMARELO")
        .when(F.col("nr_gravidade") == 1, "VERDE")
    )
    return worst.withColumn("ds_cor", colour)
