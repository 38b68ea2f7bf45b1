"""Charge-notice items -> reimbursements, their items and denials."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimspark.functions import blank_to_null, critique_line, money, split_cco
from claimspark.operators.picks import first_by
from claimspark.schemas import conform
from claimspark.sources.tables import ITEM, update_by_key

NOTICE = "cd_ressarcimento_sus"
# An attendance of one beneficiary inside one notice.
ATTENDANCE = [NOTICE, "nr_atendimento", "cd_cco_base", "nr_div_cco"]
# A summary row: the attendance split by place, on the beneficiary number as sent.
SUMMARY = [NOTICE, "cd_cco", "nr_atendimento", "nm_municipio", "cd_uf", "nm_ups"]

DENIAL_REASON = 9630
NO_PROCEDURE = -1
DUE_DAYS = 30


def with_cco(df: DataFrame) -> DataFrame:
    code, check = split_cco(F.col("cd_cco"))
    return df.withColumn("cd_cco_base", code).withColumn("nr_div_cco", check)


def exclude_reimbursed(df: DataFrame, reemb: DataFrame) -> DataFrame:
    """Drop every notice that has a reimbursement already."""
    return df.join(reemb.select(NOTICE).distinct(), NOTICE, "left_anti")


def validated_items(items: DataFrame, val: DataFrame, notices: DataFrame, only_confirmed: bool = True) -> DataFrame:
    """Items with each of their validations (an item with two counts twice)."""
    kept = items.filter(F.col("sn_confirmar") == "S") if only_confirmed else items
    of_notice = kept.join(notices.select(NOTICE, "dt_oficio"), NOTICE)
    return with_cco(of_notice.join(val.select(ITEM, "tp_validacao", "ds_mensagem"), ITEM))


def open_rows(items: DataFrame, val: DataFrame, notices: DataFrame, reemb: DataFrame, only_confirmed: bool = True) -> DataFrame:
    """What summary, items and critiques of the notices not reimbursed yet are made of: a job keeps it and scans the items once.

    The reimbursed notices are dropped from the notices before the items are joined.
    """
    rows = validated_items(items, val, exclude_reimbursed(notices, reemb), only_confirmed)
    return rows.select(
        *SUMMARY, "cd_cco_base", "nr_div_cco", "dt_inicio", "dt_fim", "cd_procedimento", "vl_procedimento", "dt_oficio",
        "tp_validacao", "ds_mensagem",
    )


def attendance_summary(items: DataFrame, val: DataFrame, notices: DataFrame, reemb: DataFrame,
                       only_confirmed: bool = True) -> DataFrame:
    """Dates, count and value per attendance and place, of notices not reimbursed yet.

    The reimbursed notices are dropped from the notices before the items are joined.
    """
    valid = val.filter(F.col("tp_validacao") != "E")
    return summary_of(validated_items(items, valid, exclude_reimbursed(notices, reemb), only_confirmed))


def summary_of(rows: DataFrame) -> DataFrame:
    """Dates, count and value per attendance and place of validated items; errors and missing types do not count."""
    totals = rows.filter(F.col("tp_validacao") != "E").groupBy(*SUMMARY).agg(
        F.max("dt_inicio").alias("dt_ultimo_inicio"),
        F.min("dt_inicio").alias("dt_atendimento"),
        F.max("dt_fim").alias("dt_alta"),
        F.count(F.lit(1)).alias("nr_qtd"),
        money(F.sum("vl_procedimento")).alias("vl_qtd"),
    )
    return with_cco(totals)


def attendance_notes(items: DataFrame, val: DataFrame, notices: DataFrame, only_confirmed: bool = True) -> DataFrame:
    """Distinct notes of an attendance."""
    noted = items.filter(F.col("ds_atendimento").isNotNull())
    return validated_items(noted, val, notices, only_confirmed).select(*ATTENDANCE, "ds_atendimento").distinct()


def map_procedures(df: DataFrame, depara: DataFrame, as_of: date) -> DataFrame:
    """Public procedure code -> own code valid at ``as_of``; unmapped is NULL."""
    day = F.lit(as_of)
    valid = depara.filter(
        (F.col("dt_inicio_vigencia").isNull() | (F.col("dt_inicio_vigencia") <= day))
        & (F.col("dt_fim_vigencia").isNull() | (F.col("dt_fim_vigencia") >= day))
    )
    table = valid.groupBy(F.col("cd_procedimento_sus").alias("cd_procedimento")).agg(
        F.min("cd_procedimento").alias("cd_procedimento_mapeado")
    )
    return df.join(table, "cd_procedimento", "left")


def attendance_items(items: DataFrame, val: DataFrame, notices: DataFrame, depara: DataFrame, as_of: date,
                     only_confirmed: bool = True) -> DataFrame:
    """Allowed value (nothing for a disputed row), original value and count per procedure."""
    return items_of(validated_items(items, val, notices, only_confirmed), depara, as_of)


def items_of(rows: DataFrame, depara: DataFrame, as_of: date) -> DataFrame:
    """Allowed value, original value and count per attendance and procedure of validated items."""
    rows = map_procedures(rows, depara, as_of)
    allowed = F.when(F.col("tp_validacao").eqNullSafe("I"), F.lit(0).cast("decimal(18,2)")).otherwise(
        F.col("vl_procedimento")
    )
    return rows.groupBy(*ATTENDANCE, "cd_cco", "cd_procedimento_mapeado", "dt_oficio").agg(
        money(F.sum(allowed)).alias("vl_qtd"),
        money(F.sum("vl_procedimento")).alias("vl_qtd_original"),
        F.count(F.lit(1)).alias("nr_qtd"),
    )


def attendance_critiques(items: DataFrame, val: DataFrame, notices: DataFrame, depara: DataFrame, as_of: date,
                         only_confirmed: bool = True) -> DataFrame:
    """Distinct validation messages of an attendance."""
    noted = val.filter(F.col("ds_mensagem").isNotNull())
    return critiques_of(validated_items(items, noted, notices, only_confirmed), depara, as_of)


def critiques_of(rows: DataFrame, depara: DataFrame, as_of: date) -> DataFrame:
    """Distinct messages per attendance of validated items."""
    return (
        map_procedures(rows.filter(F.col("ds_mensagem").isNotNull()), depara, as_of)
        .select(*ATTENDANCE, "cd_cco", "ds_mensagem", "tp_validacao", "cd_procedimento_mapeado")
        .distinct()
    )


def critique_text(critiques: DataFrame) -> DataFrame:
    """One text per attendance: a line per distinct message, by validation type.

    The messages are distinct before they are gathered, so a cell holds the
    attendance's different messages and not one entry per item.
    """
    line = F.struct(
        F.col("cd_cco"),
        F.col("tp_validacao").isNull().alias("sem_tipo"),
        F.col("tp_validacao"),
        F.col("ds_mensagem"),
        F.col("cd_procedimento_mapeado").isNull().alias("sem_procedimento"),
        F.col("cd_procedimento_mapeado"),
    )
    texts = F.transform(
        F.sort_array(F.collect_list(line)), lambda r: critique_line(r["cd_procedimento_mapeado"], r["ds_mensagem"])
    )
    return critiques.groupBy(*ATTENDANCE).agg(blank_to_null(F.trim(F.array_join(texts, ""))).alias("ds_criticas"))


def member_key(df: DataFrame) -> DataFrame:
    return df.withColumn("cd_cco_base", F.lpad(F.col("cd_cco").cast("string"), 10, "0")).withColumn(
        "nr_div_cco", F.lpad(F.col("nr_div_cco").cast("string"), 2, "0")
    )


def asked_members(rows: DataFrame) -> DataFrame:
    """The (code, check) pairs that ``summary_of`` the rows has, without its other keys: those are not moved for them."""
    return rows.filter(F.col("tp_validacao") != "E").select("cd_cco_base", "nr_div_cco").distinct()


def resolve_members(keys: DataFrame, members: DataFrame) -> DataFrame:
    """Member of a (code, check) pair; supplier of the holder, else the own one.

    Several members under one pair: the smallest registration number.
    """
    pair = ["cd_cco_base", "nr_div_cco"]
    cols = ["cd_matricula", "cd_multi_empresa", "cd_fornecedor", "cd_matricula_tem"]
    wanted = keys.select(*pair).filter(F.col("cd_cco_base").isNotNull() & F.col("nr_div_cco").isNotNull()).distinct()
    own = first_by(member_key(members).join(wanted, pair, "left_semi"), pair, [F.col("cd_matricula")], cols)
    holders = members.select(
        F.col("cd_matricula").alias("cd_matricula_tem"), F.col("cd_fornecedor").alias("cd_fornecedor_titular")
    )
    return own.join(holders, "cd_matricula_tem", "left").select(
        *pair,
        "cd_matricula",
        "cd_multi_empresa",
        F.coalesce("cd_fornecedor_titular", "cd_fornecedor").alias("cd_fornecedor"),
    )


def reimbursement_header(summary: DataFrame, members: DataFrame, texts: DataFrame, as_of: date, user: str | None,
                         tenant: int | None, job_user: str = "BATCH") -> DataFrame:
    """One reimbursement per summary row with a member.

    ``members`` is the result of ``resolve_members``, ``texts`` of ``critique_text``.
    The natural keys ride along; ``cd_reembolso`` stays NULL until ids are assigned.
    """
    pair = ["cd_cco_base", "nr_div_cco"]
    rows = summary.join(members, pair).join(texts, ATTENDANCE, "left")
    day = F.lit(as_of)

    def text(value: str | None) -> Column:
        return F.lit(value).cast("string")

    # Constants of a new reimbursement: fixed values.
    header = (
        rows.withColumn("tp_reembolso", text("R"))
        .withColumn("cd_controle_interno", F.col("nr_atendimento"))
        .withColumn("sn_quitar_mensalidade", text("N"))
        .withColumn("ds_prestador", F.substring("nm_ups", 1, 50))
        .withColumn("vl_total_original", F.col("vl_qtd"))
        .withColumn("dt_inclusao", day)
        .withColumn("cd_usuario_inclusao", text(user or job_user))
        .withColumn("dt_ultima_atualizacao", day)
        .withColumn("cd_usuario_ultima_atualizacao", text(job_user))
        .withColumn("dt_vencimento", F.date_add(day, DUE_DAYS))
        .withColumn("cd_multi_empresa", F.coalesce(F.lit(tenant).cast("bigint"), F.col("cd_multi_empresa")))
        .withColumn("tp_pessoa", text("F"))
        .withColumn("tp_status", text("E"))
        .withColumn("ds_municipio", F.col("nm_municipio"))
        .withColumn("sn_notificado", text("N"))
        .withColumn("sn_recusado", text("N"))
        .withColumn("ds_consideracoes_internas", F.col("ds_criticas"))
        .withColumn("tp_status_reembolso", text("1"))
    )
    keep = ("nr_atendimento", "cd_cco", "cd_cco_base", "nr_div_cco", "nm_municipio", "nm_ups")
    return conform(header, "reimbursement", keep)


def reimbursement_items(header: DataFrame, att_items: DataFrame, user: str | None) -> DataFrame:
    """The procedures of each reimbursement (all of the attendance, at any place)."""
    heads = header.select(*ATTENDANCE, "cd_reembolso", "nm_municipio", "cd_uf", "nm_ups")
    rows = heads.join(att_items, ATTENDANCE).select(
        "*",
        F.coalesce("cd_procedimento_mapeado", F.lit(NO_PROCEDURE)).alias("cd_procedimento"),
        F.col("vl_qtd").alias("vl_procedimento"),
        F.col("nr_qtd").alias("qt_cobrado"),
        F.col("vl_qtd_original").alias("vl_cobrado"),
        F.lit(user).cast("string").alias("cd_usuario_inclusao"),
        F.col("dt_oficio").alias("dt_usuario_inclusao"),
    )
    keep = ("cd_procedimento_mapeado", NOTICE, "nr_atendimento", "cd_cco", "nm_municipio", "cd_uf", "nm_ups")
    return conform(rows, "reimbursement_item", keep)


def reimbursement_denials(items: DataFrame, as_of: date, reason: int = DENIAL_REASON) -> DataFrame:
    """A denial for every reimbursement item allowed less than its original value."""
    zero = F.lit(0).cast("decimal(18,2)")
    rows = items.filter(F.coalesce("vl_procedimento", zero) < F.coalesce("vl_cobrado", zero)).select(
        "cd_reembolso",
        F.col("cd_procedimento_mapeado").alias("cd_procedimento"),
        F.lit(reason).alias("cd_motivo"),
        "cd_usuario_inclusao",
        F.lit(as_of).alias("dt_usuario_inclusao"),
        NOTICE, "nr_atendimento", "cd_cco", "nm_municipio", "cd_uf", "nm_ups",
    )
    return conform(rows, "reimbursement_denial", (NOTICE, "nr_atendimento", "cd_cco", "nm_municipio", "cd_uf", "nm_ups"))


def back_link(items: DataFrame, header: DataFrame) -> DataFrame:
    """Write the reimbursement id on every item of the attendance; the last one wins."""
    last = header.groupBy(*ATTENDANCE).agg(F.max("cd_reembolso").alias("cd_reembolso"))
    return update_by_key(with_cco(items), last, ATTENDANCE, ["cd_reembolso"]).select(*items.columns)


def confirm_items(items: DataFrame, staging: DataFrame, flag: str) -> DataFrame:
    """Set the confirm flag of the staged items."""
    changes = (
        staging.select(F.col("cd_item_ress_sus_anexo").alias(ITEM)).distinct().withColumn("sn_confirmar", F.lit(flag))
    )
    return update_by_key(items, changes, [ITEM], ["sn_confirmar"])
