"""Account-analysis statement: protocols, guides, procedures and denials of a request.

Amounts are worked out once per (protocol, provider) and joined to the requests that
ask for them, so many requests for one protocol do not repeat the work.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimspark.functions import blank_to_null, hour_text, money, payee, poison_sum, verdict
from claimspark.operators.dealt import SHARE, dealt_join
from claimspark.operators.picks import both_large, first_by, look_up, match_count

REQUEST = "cd_tiss_demnstrv_retorno"
PAIR = ["nr_protocolo", "cd_prestador"]
GUIDE = [*PAIR, "cd_guia_externa", "nr_guia"]
# What tells one guide line of a protocol from another.
GUIDE_LINE = [
    *GUIDE, "nm_beneficiario", "nr_carteira", "dt_inicio_fat", "dt_fim_fat", "nr_cns", "dt_realizacao",
    "nm_contratado", "sn_atendimento_recem_nato", "sn_liberado",
]
PROCEDURE = [
    "cd_lancamento", "dt_realizado", "cd_tabela", "cd_procedimento", "ds_procedimento", "cd_motivo",
    "cd_atividade_medica", "vl_total_cobrado", "vl_unit_pago",
]

# Codes and texts: fixed values.
NOT_AUDITED = ["NA", "GA"]
PAYABLE_STATUS = [3, 6]
STATUS_UNDER_ANALYSIS = 2
STATUS_NOT_FOUND = 7
GUIDE_RELEASED, GUIDE_UNDER_ANALYSIS = 5, 2
NO_CNES = 9999999
NO_TABLE = "00"
NO_REASON_CODE = "TODO_CD_TISS"
INVALID_PROVIDER = "CÓDIGO PRESTADOR INVÁLIDO"
MANY_PROVIDERS = "PRESTADOR COM MAIS DE UM REGISTRO. ENTRE EM CONTATO COM A OPERADORA"
PROTOCOL_NOT_FOUND = "PROTOCOLO NÃO ENCONTRADO"
PROTOCOL_OF_OTHER = "PROTOCOLO NÃO PERTENCE AO PRESTADOR DE CÓDIGO "


def zero() -> Column:
    return F.lit(0).cast("decimal(18,2)")


def requests(messages: DataFrame, req: DataFrame) -> DataFrame:
    """Message with its statement request; the first one if it carries several."""
    cols = [c for c in req.columns if c != "cd_pai"]
    first = first_by(req, ["cd_pai"], [F.col(REQUEST)], cols)
    sent = messages.select(
        F.col("id").alias("cd_pai"), "cd_versao", "nr_registro_ans_destino", "cd_prestador_operadora",
        "nr_cnpj_prestador_operadora", "nr_cpf_prestador_operadora", "dt_transacao", "hr_transacao",
    )
    document = F.coalesce(blank_to_null(F.col("nr_cnpj_contratado")), blank_to_null(F.col("nr_cpf_contratado")))
    return (
        first.join(both_large(sent), "cd_pai")
        .withColumnRenamed("cd_pai", "id")
        .withColumn("nr_documento", document)
        .drop("nr_cnpj_contratado", "nr_cpf_contratado")
    )


def provider_matches(req: DataFrame, providers: DataFrame) -> DataFrame:
    """Active providers of the request's tenant by tax number, internal code or code."""
    tenant = F.col("cd_multi_empresa")
    code = F.col("cd_prestador_contratado")
    rules = [
        ([tenant, F.lpad("nr_documento", 14, "0")], [tenant, F.lpad(F.col("nr_cpf_cgc").cast("string"), 14, "0")]),
        ([tenant, code.cast("string")], [tenant, F.col("cd_interno")]),
        ([tenant, code], [tenant, F.col("cd_prestador")]),
    ]
    row = F.struct("cd_prestador", "nm_prestador", "tp_credenciamento")
    found = look_up(req, providers.filter(F.col("tp_situacao") == "A"), rules, row, "_lo", "_hi")
    return found.withColumn("nr_prestadores", match_count("_lo", "_hi", "cd_prestador"))


def provider_valid(req: DataFrame, providers: DataFrame) -> DataFrame:
    """'TRUE' when the request's provider is known, 'FALSE' otherwise."""
    found = provider_matches(req, providers)
    flag = F.when(F.col("nr_prestadores") >= 1, "TRUE").otherwise("FALSE")
    return found.withColumn("sn_prestador_valido", flag).drop("_lo", "_hi", "nr_prestadores")


def contracted_provider(req: DataFrame, providers: DataFrame, addresses: DataFrame) -> DataFrame:
    """The request's provider with the facility number of its main address.

    Fields are filled only for a single match; ``nr_prestadores`` is 0, 1 or 2 (more).
    """
    found = provider_matches(req, providers)
    single = F.col("nr_prestadores") == 1
    named = found.select(
        *req.columns,
        "nr_prestadores",
        *[F.when(single, F.col(f"_hi.{c}")).alias(c) for c in ("cd_prestador", "nm_prestador", "tp_credenciamento")],
    )
    cnes = (
        addresses.filter((F.col("sn_principal") == "S") & F.col("cd_cnes").isNotNull())
        .groupBy("cd_prestador")
        .agg(F.min("cd_cnes").try_cast("bigint").alias("nr_cnes"))
    )
    return named.join(cnes, "cd_prestador", "left").withColumn(
        "nr_cnes", F.when(single, F.coalesce("nr_cnes", F.lit(NO_CNES)))
    )


def body_verdict(df: DataFrame, many: str = MANY_PROVIDERS) -> DataFrame:
    """1203 for an unknown provider, then for more than one."""
    unknown = verdict(F.col("nr_prestadores") == 0, "1203", INVALID_PROVIDER)
    several = verdict(F.col("nr_prestadores") > 1, "1203", many)
    return df.withColumn("g_corpo", F.coalesce(unknown, several))


def error_rows(df: DataFrame, header: str = "g_cabecalho", body: str = "g_corpo") -> DataFrame:
    """One error row per request with a verdict, the header's before the body's."""
    first = df.withColumn("_g", F.coalesce(header, body)).filter(F.col("_g").isNotNull())
    return first.select(
        REQUEST, "id", F.col("_g.cd_glosa").alias("cd_motivo_glosa"), F.col("_g.ds_glosa").alias("ds_motivo_glosa")
    )


def requested_protocols(req: DataFrame, protos: DataFrame) -> DataFrame:
    """One row per protocol a request asks for."""
    asked = protos.select(F.col("cd_pai").alias(REQUEST), "nr_protocolo")
    return req.join(both_large(asked), REQUEST)


def protocol_verdict(req_protos: DataFrame, protocols: DataFrame, lots: DataFrame, providers: DataFrame) -> DataFrame:
    """Protocol data, or why it cannot be shown: not found, or of another provider."""
    known = protocols.join(providers.select("cd_prestador"), "cd_prestador", "left_semi").select(
        F.col("cd_protocolo_ctamed").alias("nr_protocolo"),
        F.col("cd_prestador").alias("cd_prestador_protocolo"),
        "dt_envio_lote",
        "cd_status_protocolo",
        "cd_glosa_protocolo",
        "nr_lote_prestador",
    )
    first_lot = lots.groupBy(F.col("cd_protocolo_ctamed").alias("nr_protocolo")).agg(F.min("cd_lote").alias("cd_lote"))
    rows = req_protos.join(known, "nr_protocolo", "left").join(first_lot, "nr_protocolo", "left")
    missing = F.col("cd_prestador_protocolo").isNull()
    other = F.col("cd_prestador_protocolo") != F.col("cd_prestador")
    text = F.concat(F.lit(PROTOCOL_OF_OTHER), F.col("cd_prestador").cast("string"))
    judged = rows.withColumn(
        "g_protocolo",
        F.coalesce(verdict(missing, "5013", PROTOCOL_NOT_FOUND), verdict(other, "5013", text)),
    )
    sent = F.when(missing, F.col("dt_solicitacao").cast("timestamp_ntz")).otherwise(F.col("dt_envio_lote"))
    return (
        judged.withColumn("dt_envio_lote", sent)
        .withColumn("nr_lote_prestador", F.when(missing, F.lit(0)).otherwise(F.col("nr_lote_prestador")))
        .withColumn(
            "cd_status_protocolo",
            F.when(F.col("g_protocolo").isNotNull(), F.lit(STATUS_NOT_FOUND)).otherwise(F.col("cd_status_protocolo")),
        )
    )


def shown_lots(judged: DataFrame, lots: DataFrame, invoices: DataFrame) -> DataFrame:
    """Lots of the protocols that can be shown, with the asking provider and the invoice if there is one."""
    wanted = (
        judged.filter(F.col("g_protocolo").isNull())
        .select("nr_protocolo", F.col("cd_prestador").alias("cd_prestador_pedido"))
        .distinct()
    )
    billed = invoices.select(F.col("cd_fatura").alias("cd_fatura_lote")).distinct()
    return (
        lots.select("cd_lote", F.col("cd_protocolo_ctamed").alias("nr_protocolo"), "cd_fatura")
        .join(wanted, "nr_protocolo")
        .join(billed, F.col("cd_fatura") == F.col("cd_fatura_lote"), "left")
        .drop("cd_fatura")
    )


def claims_of(shown: DataFrame, claims: DataFrame) -> DataFrame:
    """Claim lines of the lots of ``shown_lots``, the small side of the join."""
    return claims.join(shown, "cd_lote")


def protocol_claims(judged: DataFrame, claims: DataFrame, lots: DataFrame, invoices: DataFrame) -> DataFrame:
    """Claim lines of the protocols that can be shown, with the asking provider."""
    return claims_of(shown_lots(judged, lots, invoices), claims)


def is_audited() -> Column:
    return ~F.col("tp_situacao").isin(NOT_AUDITED)


def is_paid_to_asker() -> Column:
    return payee(F.col("cd_prestador_principal"), F.col("cd_prestador")) == F.col("cd_prestador_pedido")


def pair_totals(rows: DataFrame) -> DataFrame:
    """Charged, denied and paid per (protocol, provider), in one pass over the claims.

    Charged and denied come from the audited lines of the principal provider, for the
    smallest invoice only; paid from every line paid to the provider.
    """
    shown = is_audited() & (F.col("cd_prestador_principal") == F.col("cd_prestador_pedido"))
    pair = ["nr_protocolo", "cd_prestador_pedido"]
    per_invoice = rows.groupBy(*pair, "cd_fatura", "cd_fatura_lote").agg(
        F.count(F.when(shown, 1)).alias("n"),
        F.sum(F.when(shown, F.col("vl_total_cobrado"))).alias("cobrado"),
        F.sum(F.when(shown, F.col("vl_total_glosado"))).alias("glosado"),
        F.sum(F.when(is_paid_to_asker(), F.col("vl_total_pago"))).alias("pago"),
    )
    order = F.when(
        F.col("n") > 0,
        F.struct(
            F.col("cd_fatura_lote").isNull(), F.col("cd_fatura_lote"), F.col("cd_fatura").isNull(), F.col("cd_fatura")
        ),
    )
    first = per_invoice.groupBy(*pair).agg(
        F.min_by(F.struct("cobrado", "glosado"), order).alias("_first"), money(F.sum("pago")).alias("vl_pago")
    )
    return first.select(
        "nr_protocolo",
        F.col("cd_prestador_pedido").alias("cd_prestador"),
        F.col("_first").isNotNull().alias("sn_auditado"),
        money(F.col("_first.cobrado")).alias("vl_cobrado"),
        money(F.col("_first.glosado")).alias("vl_glosado"),
        "vl_pago",
    )


def protocol_totals(judged: DataFrame, rows: DataFrame, denial: DataFrame) -> DataFrame:
    """Values and final status of each requested protocol.

    Values are looked at only for statuses 3 and 6; one of those without audited lines
    goes back to under analysis. A denial code on the protocol itself shows up here.
    """
    texts = denial.groupBy(F.col("cd_glosa").alias("cd_glosa_protocolo")).agg(F.min("ds_glosa").alias("_ds_glosa"))
    full = judged.join(pair_totals(rows), PAIR, "left").join(texts, "cd_glosa_protocolo", "left")
    refused = F.col("g_protocolo").isNotNull()
    payable = ~refused & F.coalesce(F.col("cd_status_protocolo").isin(PAYABLE_STATUS), F.lit(False))
    found = payable & F.coalesce("sn_auditado", F.lit(False))

    def value(c: str) -> Column:
        return F.when(found, F.col(c)).otherwise(zero())

    return full.select(
        *judged.columns[: judged.columns.index("g_protocolo")],
        "g_protocolo",
        F.when(refused, F.col("g_protocolo.cd_glosa")).when(found, F.col("cd_glosa_protocolo")).alias("cd_motivo_glosa"),
        F.when(refused, F.col("g_protocolo.ds_glosa")).when(found, F.col("_ds_glosa")).alias("ds_motivo_glosa"),
        F.when(payable & ~found, F.lit(STATUS_UNDER_ANALYSIS))
        .otherwise(F.col("cd_status_protocolo"))
        .alias("cd_status_final"),
        value("vl_cobrado").alias("vl_informado_protocolo"),
        value("vl_cobrado").alias("vl_processado_protocolo"),
        value("vl_pago").alias("vl_protocolo"),
        value("vl_glosado").alias("vl_glosa_protocolo"),
    )


def released_flag(rows: DataFrame) -> DataFrame:
    """Accounts with at least one paid line of origin 2 without a denial reason."""
    return (
        rows.filter((F.col("tp_origem") == 2) & F.col("cd_motivo").isNull() & (F.col("vl_total_pago") > 0))
        .select("cd_conta_medica", "cd_lote")
        .distinct()
    )


def guide_paid(keys: DataFrame, rows: DataFrame) -> DataFrame:
    """Paid to the provider on lines that share the external OR the own guide number.

    The lines of either number are the lines of the one plus those of the other minus
    those of both, so three small sums replace the OR and no line is listed twice.
    """
    base = (
        rows.filter(is_paid_to_asker())
        .groupBy("nr_protocolo", F.col("cd_prestador_pedido").alias("cd_prestador"), "cd_guia_externa", "nr_guia")
        .agg(F.sum("vl_total_pago").alias("s"), F.count("vl_total_pago").alias("n"))
    )

    def sums(cols: list[str], tag: str) -> DataFrame:
        kept = base
        for c in cols:
            kept = kept.filter(F.col(c).isNotNull())
        return kept.groupBy(*PAIR, *cols).agg(F.sum("s").alias(f"s_{tag}"), F.sum("n").alias(f"n_{tag}"))

    out = keys.select(*GUIDE).distinct()
    for cols, tag in ((["cd_guia_externa"], "ext"), (["nr_guia"], "own"), (["cd_guia_externa", "nr_guia"], "both")):
        out = out.join(sums(cols, tag), [*PAIR, *cols], "left")

    def either(p: str) -> Column:
        ext, own, both = (F.coalesce(f"{p}_{t}", F.lit(0)) for t in ("ext", "own", "both"))
        return ext + own - both

    return out.select(*GUIDE, F.when(either("n") > 0, money(either("s"))).alias("vl_liberado"))


def same_guide(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on the guide key, where a missing guide number equals a missing one."""
    renamed = right.select(*[F.col(c).alias(f"_{c}") for c in GUIDE], *[c for c in right.columns if c not in GUIDE])
    on = [
        F.col("nr_protocolo") == F.col("_nr_protocolo"),
        F.col("cd_prestador") == F.col("_cd_prestador"),
        F.col("cd_guia_externa").eqNullSafe(F.col("_cd_guia_externa")),
        F.col("nr_guia").eqNullSafe(F.col("_nr_guia")),
    ]
    return left.join(renamed, on, how).drop(*[f"_{c}" for c in GUIDE])


def guide_lines(rows: DataFrame, guides: DataFrame, members: DataFrame, providers: DataFrame) -> DataFrame:
    """Audited lines of the executing provider, grouped as the inner level of the guide totals."""
    executed = rows.filter(is_audited() & (F.col("cd_prestador") == F.col("cd_prestador_pedido")))
    people = members.select(
        F.col("cd_matricula").alias("_matricula"), F.col("nm_segurado").alias("_segurado"), F.col("nr_cns").alias("nr_cns")
    )
    names = providers.select("cd_prestador", F.col("nm_prestador").alias("_nm_prestador"))
    cards = guides.select("nr_guia", F.col("cd_matricula").alias("_gui_matricula"), "sn_atendimento_recem_nato")
    full = (
        executed.join(cards, "nr_guia", "left")
        .join(people, F.col("_gui_matricula") == F.col("_matricula"), "left")
        .join(names, "cd_prestador", "left")
    )
    inner = [
        "nr_protocolo", "cd_prestador", "cd_guia_externa", "nr_guia", "_segurado", "_matricula", "nm_beneficiario",
        "vl_total_cobrado", "nr_carteira_beneficiario", "dt_entrada", "dt_saida", "nr_cns", "dt_realizado",
        "nm_prestador", "_nm_prestador", "sn_atendimento_recem_nato", "cd_conta_medica", "cd_lote", "id_tiss_item",
    ]
    return full.groupBy(*inner).agg(
        F.sum(F.col("qt_cobrado") * F.col("vl_unit_cobrado")).alias("vl_processado"),
        F.sum("vl_total_glosado").alias("vl_glosado"),
    )


def guide_totals(rows: DataFrame, guides: DataFrame, members: DataFrame, providers: DataFrame) -> DataFrame:
    """Values per guide line of a (protocol, provider).

    Two levels: equal lines of an item count once for the informed value, and the paid
    value of the guide repeats for every inner group.
    """
    inner = guide_lines(rows, guides, members, providers)
    flags = released_flag(rows).withColumn("sn_liberado", F.lit("S"))
    flagged = inner.join(flags, ["cd_conta_medica", "cd_lote"], "left")
    paid = same_guide(flagged, guide_paid(inner, rows), "left").select(
        *GUIDE,
        F.coalesce("_segurado", "nm_beneficiario").alias("nm_beneficiario"),
        F.coalesce(F.col("_matricula").cast("string"), F.col("nr_carteira_beneficiario")).alias("nr_carteira"),
        F.col("dt_entrada").alias("dt_inicio_fat"),
        F.col("dt_saida").alias("dt_fim_fat"),
        "nr_cns",
        F.col("dt_realizado").alias("dt_realizacao"),
        F.coalesce("nm_prestador", "_nm_prestador").alias("nm_contratado"),
        "sn_atendimento_recem_nato",
        F.coalesce("sn_liberado", F.lit("N")).alias("sn_liberado"),
        "vl_processado",
        "vl_liberado",
        "vl_glosado",
        F.col("vl_total_cobrado").alias("vl_informado"),
    )
    values = ("vl_processado", "vl_liberado", "vl_glosado", "vl_informado")
    totals = paid.groupBy(*GUIDE_LINE).agg(*[money(F.sum(v)).alias(v) for v in values])
    status = F.when(F.col("sn_liberado") == "S", GUIDE_RELEASED).otherwise(GUIDE_UNDER_ANALYSIS)
    return totals.withColumn("cd_status_guia", status)


def guide_procedures(keys: DataFrame, rows: DataFrame, share: int = SHARE) -> DataFrame:
    """Charged, released, denied and quantity per launch of a guide.

    A launch belongs to a guide by its own number, or by the external number when the
    own one differs: two disjoint equi-joins instead of an OR. Lines are summed before
    they are joined. Every guide of an external number lists the launches of all the others, so a number that very many
    guides share is dealt over several tasks, ``share`` guides and launches each.
    """
    sums = {"vl_informado": "vl_total_cobrado", "vl_liberado": "vl_total_pago", "vl_glosa": "vl_total_glosado",
            "qt_executada": "qt_pago"}
    base = (
        rows.filter(is_audited() & is_paid_to_asker())
        .groupBy(
            "nr_protocolo",
            F.col("cd_prestador_pedido").alias("_pedido"),
            F.col("cd_guia_externa").alias("_ext"),
            F.col("nr_guia").alias("_own"),
            *PROCEDURE,
        )
        .agg(*[F.sum(src).alias(out) for out, src in sums.items()])
        .withColumnRenamed("_pedido", "cd_prestador")
    )
    wanted = keys.select(*GUIDE).distinct()
    own_known, ext_known = F.col("nr_guia").isNotNull(), F.col("cd_guia_externa").isNotNull()
    by_own = dealt_join(
        wanted.filter(own_known), base.withColumn("nr_guia", F.col("_own")).filter(own_known), [*PAIR, "nr_guia"], share
    )
    by_ext = dealt_join(
        wanted.filter(ext_known), base.withColumn("cd_guia_externa", F.col("_ext")).filter(ext_known),
        [*PAIR, "cd_guia_externa"], share,
    ).filter(
        ~F.coalesce(F.col("nr_guia") == F.col("_own"), F.lit(False))
    )
    cols = [*GUIDE, *PROCEDURE, *sums]
    both = by_own.select(*cols).unionByName(by_ext.select(*cols))
    return both.groupBy(*GUIDE, *PROCEDURE).agg(*[money(F.sum(v)).alias(v) for v in sums])


def procedure_table(procs: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Table code of a procedure: the smallest of the tables (by code) that list it, else '00'."""
    listed = reduce(DataFrame.unionAll, (t.select("cd_procedimento", F.lit(code).alias("cd_tabela")) for code, t in tables.items()))
    first = listed.groupBy("cd_procedimento").agg(F.min("cd_tabela").alias("_tabela"))
    return (
        procs.join(first, "cd_procedimento", "left")
        .withColumn("cd_tipo_tabela", F.coalesce("_tabela", F.lit(NO_TABLE)))
        .drop("_tabela")
    )


def denial_reason(procs: DataFrame, reasons: DataFrame) -> DataFrame:
    """Reason text and code of the denied procedures; an unknown reason leaves both empty."""
    known = reasons.groupBy("cd_motivo").agg(
        F.min_by(F.struct("ds_motivo", "cd_tiss"), F.col("ds_motivo")).alias("_r")
    )
    code = F.when(F.col("_r").isNotNull(), F.coalesce("_r.cd_tiss", F.lit(NO_REASON_CODE)))
    return (
        procs.filter(F.col("cd_motivo").isNotNull())
        .join(known, "cd_motivo", "left")
        .withColumn("cd_motivo_glosa", code)
        .withColumn("ds_motivo_glosa", F.col("_r.ds_motivo"))
        .drop("_r")
    )


def statement_totals(req: DataFrame, totals: DataFrame) -> DataFrame:
    """Sums over the protocols of a request; one missing value empties the sum."""
    pairs = {
        "vl_informado_geral": "vl_informado_protocolo",
        "vl_processado_geral": "vl_processado_protocolo",
        "vl_liberado_geral": "vl_protocolo",
        "vl_glosa_geral": "vl_glosa_protocolo",
    }
    summed = totals.groupBy(REQUEST).agg(
        F.lit(True).alias("_any"), *[money(poison_sum(F.col(src))).alias(out) for out, src in pairs.items()]
    )
    return (
        req.join(both_large(summed), REQUEST, "left")
        .select(*req.columns, *[F.when(F.col("_any"), F.col(c)).otherwise(zero()).alias(c) for c in pairs])
    )


def day_text(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def statement_rows(req_totals: DataFrame, as_of: date, *ids: str) -> DataFrame:
    return req_totals.select(
        *ids, REQUEST, "id", "nr_registro_ans", "ds_operadora", "nr_cnpj_operadora",
        F.lit(as_of.isoformat()).alias("dt_emissao"), "cd_prestador",
        F.col("nm_prestador").alias("ds_prestador"), F.col("nr_cnes").alias("nr_cnes_prestador"),
        "vl_informado_geral", "vl_processado_geral", "vl_liberado_geral", "vl_glosa_geral",
    )


def protocol_rows(totals: DataFrame, *ids: str) -> DataFrame:
    return totals.select(
        *ids, REQUEST, F.col("nr_lote_prestador").alias("nr_lote"), "nr_protocolo",
        day_text("dt_envio_lote").alias("dt_envio_lote"),
        F.col("cd_motivo_glosa").alias("cd_motivo_glosa_protocolo"), "ds_motivo_glosa",
        F.col("cd_status_final").alias("cd_status_protocolo"), "vl_informado_protocolo", "vl_processado_protocolo",
        "vl_protocolo", "vl_glosa_protocolo",
    )


def open_protocols(totals: DataFrame, *ids: str) -> DataFrame:
    """Requested protocols without a denial: only these list guides, whatever the status."""
    return totals.filter(F.col("cd_motivo_glosa").isNull()).select(*ids, REQUEST, *PAIR)


def guides_of(totals: DataFrame, lines: DataFrame, *ids: str) -> DataFrame:
    """The guide lines of each open protocol of a request; ``ids`` of the protocol come along."""
    return open_protocols(totals, *ids).join(lines, PAIR)


def guide_rows(of_protocols: DataFrame, *ids: str) -> DataFrame:
    return of_protocols.select(
        *ids, REQUEST, "nr_protocolo", F.col("cd_guia_externa").alias("nr_guia_prestador"),
        F.col("nr_guia").alias("nr_guia_operadora"), F.col("nr_guia").alias("nr_senha"), "nm_beneficiario",
        F.col("nr_carteira").alias("nr_numero_carteira"), "dt_inicio_fat",
        hour_text(F.col("dt_inicio_fat")).alias("hr_inicio_fat"), "dt_fim_fat",
        hour_text(F.col("dt_fim_fat")).alias("hr_fim_fat"), F.col("cd_status_guia").alias("cd_status_protocolo"),
        F.col("vl_informado").alias("vl_informado_guia"), F.col("vl_processado").alias("vl_processado_guia"),
        F.col("vl_liberado").alias("vl_liberado_guia"), F.col("vl_glosado").alias("vl_glosa_guia"),
    )


# Columns that tell which guide line a procedure row hangs under.
PARENT = ["nm_beneficiario", "nr_carteira", "dt_inicio_fat", "dt_fim_fat", "dt_realizacao", "cd_status_guia"]


def procedures_of(of_protocols: DataFrame, procs: DataFrame, *ids: str) -> DataFrame:
    """Every guide line repeats the procedures of its guide; ``ids`` of the line come along."""
    return same_guide(of_protocols.select(*ids, REQUEST, *GUIDE, *PARENT), procs, "inner")


def _procedure_keys() -> list[Column]:
    return [
        F.col(REQUEST), F.col("nr_protocolo"), F.col("cd_guia_externa").alias("nr_guia_prestador"),
        F.col("nr_guia").alias("nr_guia_operadora"), *[F.col(c) for c in PARENT], F.col("cd_lancamento"),
    ]


def procedure_rows(of_lines: DataFrame, *ids: str) -> DataFrame:
    return of_lines.select(
        *ids, *_procedure_keys(), F.col("dt_realizado").alias("dt_execucao"), "cd_tipo_tabela", "cd_procedimento",
        "ds_procedimento", F.col("cd_atividade_medica").alias("cd_grau_participacao"), "vl_informado", "qt_executada",
        F.col("vl_informado").alias("vl_processado"), "vl_liberado",
    )


def denial_rows(of_lines: DataFrame, reasons: DataFrame, *ids: str) -> DataFrame:
    return denial_reason(of_lines, reasons).select(
        *ids, *_procedure_keys(), "cd_procedimento", "cd_motivo_glosa", "ds_motivo_glosa", "vl_glosa"
    )
