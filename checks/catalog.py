"""One entry per operator: the Spark call, the SQL step it must equal, the columns compared."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import oracle
from checks.derived import Derived
from claimspark.functions import hour_text, payee, split_cco
from claimspark.operators import analysis as a
from claimspark.operators import dispatch as d
from claimspark.operators import header as h
from claimspark.operators import ledger as c
from claimspark.operators import listing as v
from claimspark.operators import payment as p
from claimspark.operators import reimburse as r
from claimspark.operators.picks import both_large
from claimspark.plans import reimbursement as job
from claimspark.plans import statements as st
from claimspark.plans import storage as store
from claimspark.plans.headers import resolved_headers, validate_headers
from claimspark.schemas import PROCEDURE_TABLES
from claimspark.session import shared_dir, staged
from claimspark.sources import tables as s
from claimspark.sources.keyed import KeyedTable
from claimspark.sources.keys import assign_ids
from claimspark.sources.sequences import Sequence

AS_OF = date(2024, 1, 31)
TENANT = 1
USER = "U1"


# Derived tables that the jobs read, made side by side.
HEADER_TABLES = [f"fx_{n}" for n in (
    "message", "request", "insurer", "company", "provider", "termination", "address", "address_authoriser", "authoriser", "config"
)]
PROTOCOL_TABLES = [f"fx_{n}" for n in ("claim", "req_proto", "protocol", "lot", "invoice", "denial")]
GUIDE_TABLES = [*PROTOCOL_TABLES, "fx_guide", "fx_member"]
ANALYSIS_TABLES = [*GUIDE_TABLES, "fx_reason", *(f"fx_proctable_{c}" for c in PROCEDURE_TABLES)]
# What the grains above the procedures read.
GRAIN_TABLES = {"statement": PROTOCOL_TABLES, "protocol": PROTOCOL_TABLES, "guide": GUIDE_TABLES, "error": []}
PAYMENT_TABLES = [f"fx_{n}" for n in (
    "claim", "transfer", "invoice", "payable", "payable_item", "payment", "ownpay", "lot", "protocol", "batch_guide", "creddeb",
    "supplier", "bank",
)]
STATEMENT_TABLES = [*HEADER_TABLES, *ANALYSIS_TABLES, *PAYMENT_TABLES]


class Frames(Derived):
    """Domain tables and the intermediate frames that several entries start from."""

    def scratch(self, name: str) -> str:
        return f"{shared_dir(self.spark)}/checks/{name}-{uuid.uuid4().hex}"

    # charge notices
    @property
    def base(self):
        return self["item"], self["validation"], self["notice"]

    def summary(self, confirmed: bool = True) -> DataFrame:
        return r.attendance_summary(*self.base, self["reimb"], confirmed)

    def lines(self, confirmed: bool = True) -> DataFrame:
        return r.attendance_items(*self.base, self["depara"], AS_OF, confirmed)

    def critiques(self, confirmed: bool = True) -> DataFrame:
        return r.attendance_critiques(*self.base, self["depara"], AS_OF, confirmed)

    @cached_property
    def draft(self) -> DataFrame:
        return job.draft(*self.base, self["reimb"], self["member"], self["depara"], AS_OF, USER, TENANT)

    @cached_property
    def heads(self) -> DataFrame:
        return assign_ids(self.draft, job.ORDER, 1, "cd_reembolso")

    @cached_property
    def job(self) -> dict[str, DataFrame]:
        return job.generate_reimbursements(
            *self.base, self["reimb"], self["member"], self["depara"], AS_OF, USER, TENANT
        )

    # headers
    @cached_property
    def read(self) -> DataFrame:
        return h.message_fields(self["message"], AS_OF)

    @cached_property
    def planned(self) -> DataFrame:
        return h.check_tenant(h.resolve_plan(h.check_version(self.read), self["insurer"], self["company"]))

    @cached_property
    def provided(self) -> DataFrame:
        return h.resolve_provider(self.planned, self["provider"], TENANT)

    @cached_property
    def resolved(self) -> DataFrame:
        return staged(resolved_headers(
            self["message"], self["insurer"], self["company"], self["provider"], self["termination"], self["config"], AS_OF, TENANT
        ))

    def matched(self, clean: bool = True) -> DataFrame:
        return h.match_credentials(
            self.resolved, self["provider"], self["address"], self["address_authoriser"], self["authoriser"], self["config"],
            TENANT, clean
        )

    # analysis, on all requests of the tenant
    @cached_property
    def asked(self) -> DataFrame:
        return a.requests(self["message"], self["request"]).withColumn("cd_multi_empresa", F.lit(TENANT).cast("bigint"))

    @cached_property
    def contracted(self) -> DataFrame:
        return staged(a.contracted_provider(self.asked, self["provider"], self["address"]))

    @cached_property
    def fine(self) -> DataFrame:
        of_kind = F.col("tp_demonstrativo").isin(d.ANALYSIS_TYPES)
        return a.body_verdict(self.contracted.filter(of_kind)).filter(F.col("g_corpo").isNull())

    @cached_property
    def judged(self) -> DataFrame:
        asked = a.requested_protocols(self.fine, self["req_proto"])
        return staged(a.protocol_verdict(asked, self["protocol"], self["lot"], self["provider"]))

    @cached_property
    def rows(self) -> DataFrame:
        return staged(a.protocol_claims(self.judged, self["claim"], self["lot"], self["invoice"]))

    @cached_property
    def totals(self) -> DataFrame:
        # read once: the claims' columns that no total needs are not kept on the way
        rows = a.protocol_claims(self.judged, self["claim"], self["lot"], self["invoice"])
        return a.protocol_totals(self.judged, rows, self["denial"])

    @cached_property
    def inner(self) -> DataFrame:
        return staged(a.guide_lines(self.rows, self["guide"], self["member"], self["provider"]))

    @cached_property
    def procs(self) -> DataFrame:
        return a.guide_procedures(self.inner, self.rows)

    # payment, on all requests of the tenant
    @cached_property
    def periods(self) -> DataFrame:
        return p.parse_period(self.contracted.filter(F.col("tp_demonstrativo").isin(d.PAYMENT_TYPES)))

    @cached_property
    def payable_requests(self) -> DataFrame:
        return staged(p.payment_verdict(self.periods).filter(F.col("g_corpo").isNull()))

    @cached_property
    def dates(self) -> DataFrame:
        return staged(p.payment_dates(
            self.payable_requests, self["transfer"], self["invoice"], self["payable"], self["payable_item"],
            self["payment"], self["provider"], self["ownpay"], self["config"],
        ))

    @cached_property
    def items(self) -> DataFrame:
        return staged(p.payment_items(
            self.dates, self["transfer"], self["invoice"], self["payable"], self["payable_item"], self["payment"],
            self["provider"], self["config"],
        ))

    @cached_property
    def transfer_sums(self) -> DataFrame:
        wanted = p.transfers_of(self.items, self["transfer"])
        return staged(p.transfer_summary(wanted, self["claim"], self["lot"], self["protocol"], self["batch_guide"]))

    @cached_property
    def payable_credits(self) -> DataFrame:
        return staged(p.payable_credits(
            self.items, self["transfer"], self["protocol"], self["lot"], self["claim"], self["creddeb"]
        ))

    @cached_property
    def credits(self) -> DataFrame:
        return p.credits_debits(self.items, self.payable_credits)

    def item_totals(self, per_item: bool = False) -> DataFrame:
        return p.item_totals(self.items, self["transfer"], self.transfer_sums, self.payable_credits, per_item)

    @cached_property
    def of_supplier(self) -> DataFrame:
        return p.supplier_of_item(self["payable_item"], self["payable"], self["supplier"])

    # whole jobs, with header verdict and gate
    @cached_property
    def gated(self) -> DataFrame:
        self.prepare(*HEADER_TABLES)
        return staged(st.judged_requests(self, AS_OF, TENANT))

    def analysis(self, grain: str) -> DataFrame:
        self.prepare(*HEADER_TABLES, *GRAIN_TABLES.get(grain, ANALYSIS_TABLES))
        return st.analysis_statement(self.gated.filter(F.col("ds_destino") == "ANALISE"), self, AS_OF)[grain]

    def payment(self, grain: str) -> DataFrame:
        self.prepare(*HEADER_TABLES, *PAYMENT_TABLES)
        return st.payment_statement(self.gated.filter(F.col("ds_destino") == "PAGAMENTO"), self, AS_OF)[grain]

    #: Where the statements of a data set are stored, by session and folder: several entries read them.
    _stored: dict[tuple[str, str], str] = {}

    def stored(self, *chain: tuple[str, str]) -> DataFrame:
        """Stored rows with those above them, by id: (table, column that holds the parent's id) from the lowest up to the reply."""
        whose = (self.spark.sparkContext.applicationId, self.sf_dir)
        if whose not in self._stored:
            base = self.scratch("statements")
            self.prepare(*STATEMENT_TABLES)
            store.write_statements(self, base, "lote1", AS_OF, TENANT)
            self._stored[whose] = base
        base = self._stored[whose]
        rows = None
        for depth, (name, parent) in enumerate((*chain, ("reply", "cd_tiss_mensagem_origem"))):
            table = self.spark.read.parquet(f"{base}/{name}").drop("id_lote_carga")
            own = table.columns[0]
            table = table.select(*[F.col(c).alias(f"{c}_{depth}") for c in table.columns])
            rows = table if rows is None else rows.join(both_large(table), F.col("_up") == F.col(f"{own}_{depth}"))
            rows = rows.withColumn("_up", F.col(f"{parent}_{depth}"))
        return rows.withColumnRenamed("_up", "id")

    @cached_property
    def numbered(self) -> DataFrame:
        failed = d.failed_requests(a.requests(self["message_mixed"], self["request"]))
        return assign_ids(failed, ["id"], 1, "cd_tiss_mensagem_log")


def plain(df: DataFrame) -> DataFrame:
    """Text, bigint and double only; a verdict becomes two columns."""
    out = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StructType):
            out += [col["cd_glosa"].alias(f"{f.name}_cd"), col["ds_glosa"].alias(f"{f.name}_ds")]
        elif isinstance(f.dataType, T.DecimalType):
            out.append(col.cast("decimal(18,2)").cast("double").alias(f.name))
        elif isinstance(f.dataType, T.IntegralType | T.BooleanType):
            out.append(col.cast("bigint").alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            out.append(F.date_format(col, "yyyy-MM-dd").alias(f.name))
        elif isinstance(f.dataType, T.TimestampType | T.TimestampNTZType):
            out.append(F.date_format(col, "yyyy-MM-dd HH:mm:ss").alias(f.name))
        else:
            out.append(col.cast("string").alias(f.name))
    return df.select(*out)


@dataclass(frozen=True)
class Entry:
    build: Callable[[Frames], DataFrame]
    step: str
    spec: str

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        names = [item.split(":")[0] for item in self.spec.split()]
        return plain(self.build(Frames(spark, sf_dir))).select(*names)

    def sql(self) -> str:
        return oracle.query(self.step, self.spec)


ENTRIES: dict[str, Entry] = {}


def entry(name: str, step: str, spec: str):
    def add(build: Callable[[Frames], DataFrame]):
        ENTRIES[name] = Entry(build, step, " ".join(spec.split()))
        return build

    return add


# --- sources and sinks ------------------------------------------------------------


@entry("s1_read_table", "o_scan", "o_orderkey:i o_custkey:i o_orderdate:t o_totalprice:m")
def _(t):
    ddl = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz,"
           " o_orderpriority string")
    rows = s.read_table(t.spark, t.sf_dir, "orders", ddl)
    return rows.select("o_orderkey", "o_custkey", "o_orderdate", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"))


@entry("s2_config", "o_config", "cd_matricula:i cd_multi_empresa:i ds_folha:s ds_ausente:s")
def _(t):
    rows = s.config(t["member"], t["config"], "CONTMED_FOLHA_PGTO", "N", out="ds_folha")
    return s.config(rows, t["config"], "CHAVE_AUSENTE", "N", out="ds_ausente")


KEYS_R1 = "cd_ressarcimento_sus:i cd_cco:i nr_atendimento:i nm_municipio:s cd_uf:s nm_ups:s "
KEYS_ATT = "cd_ressarcimento_sus:i nr_atendimento:i cd_cco_base:s nr_div_cco:s "


@entry("s3_append", "o_summary", KEYS_R1 + "nr_qtd:i vl_qtd:m")
def _(t):
    path = t.scratch("append")
    for _attempt in range(2):  # a repeated batch replaces itself
        s.append(t.summary(), path, "lote1")
    return t.spark.read.parquet(path)


@entry("s4_update_by_key", "o_confirmed", "cd_item_ressarciment_sus_anexo:i sn_confirmar:s vl_procedimento:m")
def _(t):
    changes = t["staging"].select(F.col("cd_item_ress_sus_anexo").alias(s.ITEM), F.lit("N").alias("sn_confirmar"))
    stored = KeyedTable(t.spark, t.scratch("keyed"), t["item"].schema, s.ITEM)
    stored.create(t["item"], 8)
    stored.update(changes, [s.ITEM], ["sn_confirmar"])
    return stored.read()


@entry("s5_consume_staging", "o_consumed", "ds_tabela:s cd_item_ress_sus_anexo:i")
def _(t):
    staging, path = t.scratch("staging"), t.scratch("taken")
    t["staging"].write.mode("overwrite").parquet(staging)
    s.consume_staging(t.spark, staging, path)
    read = s.taken_rows(t.spark, path, t["staging"].schema).withColumn("ds_tabela", F.lit("LIDO"))
    left = t.spark.read.parquet(staging).withColumn("ds_tabela", F.lit("SOBRA"))  # the stored table, read again
    return read.unionByName(left)


@entry("s6_import_items", "o_item", """cd_item_ressarciment_sus_anexo:i cd_ressarcimento_sus:i nr_atendimento:i cd_cco:i
    nm_ups:s nm_municipio:s cd_uf:s dt_inicio:t dt_fim:t cd_procedimento:i vl_procedimento:m ds_atendimento:s""")
def _(t):
    path = t.scratch("import")
    s.export_items(t["item"], path)
    return s.import_items(t.spark, path).filter(F.col(s.BAD_LINE).isNull())


@entry("s7_assign_ids", "o_head", "cd_reembolso:i " + KEYS_R1)
def _(t):
    return t.heads


@entry("s7_leased_ids", "o_head", "cd_reembolso:i " + KEYS_R1)
def _(t):
    numbers = Sequence(t.spark, t.scratch("numbers"), "seq_reembolso")
    for _attempt in range(2):  # a job that is run again gets its block again
        rows = assign_ids(t.draft, job.ORDER, lambda n: numbers.lease(n, "lote1"), "cd_reembolso")
    return rows


@entry("s8_export_impugned", "o_impugned", """cd_valida_item_ress_sus_anexo:i cd_item_ressarciment_sus_anexo:i
    cd_ressarcimento_sus:i nr_atendimento:i cd_cco:i cd_procedimento:i vl_procedimento:m ds_mensagem:s""")
def _(t):
    path = t.scratch("export")
    s.export_impugned(t["item"], t["validation"], path)
    schema = s.impugned(t["item"], t["validation"]).schema
    return t.spark.read.schema(schema).option("header", True).option("sep", ";").csv(path)


# --- charge-notice reimbursement --------------------------------------------------

SUMMARY = KEYS_R1 + "cd_cco_base:s nr_div_cco:s dt_ultimo_inicio:t dt_atendimento:t dt_alta:t nr_qtd:i vl_qtd:m"
LINES = KEYS_ATT + "cd_cco:i cd_procedimento_mapeado:i dt_oficio:d vl_qtd:m vl_qtd_original:m nr_qtd:i"
CRITIQUES = KEYS_ATT + "cd_cco:i ds_mensagem:s tp_validacao:s cd_procedimento_mapeado:i"

entry("r1_attendance_summary", "o_summary", SUMMARY)(lambda t: t.summary())
entry("r2_exclude_reimbursed", "o_guard", "cd_ressarcimento_sus:i dt_oficio:d cd_multi_empresa:i")(
    lambda t: r.exclude_reimbursed(t["notice"], t["reimb"])
)


@entry("r3_split_cco", "o_split", "cd_cco:i cd_cco_base:s nr_div_cco:s")
def _(t):
    code, check = split_cco(F.col("cd_cco"))
    return t["item"].select("cd_cco", code.alias("cd_cco_base"), check.alias("nr_div_cco")).distinct()


entry("r4_attendance_notes", "o_notes", KEYS_ATT + "ds_atendimento:s")(lambda t: r.attendance_notes(*t.base))
entry("r5_attendance_items", "o_lines", LINES)(lambda t: t.lines())
entry("r6_attendance_critiques", "o_critiques", CRITIQUES)(lambda t: t.critiques())
entry("r7_critique_text", "o_text", KEYS_ATT + "ds_criticas:s")(lambda t: r.critique_text(t.critiques()))
entry("r8_resolve_members", "o_resolved",
      "cd_cco_base:s nr_div_cco:s cd_matricula:i cd_multi_empresa:i cd_fornecedor:i")(
    lambda t: r.resolve_members(r.asked_members(r.open_rows(*t.base, t["reimb"])), t["member"])
)
entry("r9_map_procedures", "o_mapped", "cd_item_ressarciment_sus_anexo:i cd_procedimento:i cd_procedimento_mapeado:i")(
    lambda t: r.map_procedures(t["item"], t["depara"], AS_OF)
)
HEAD = KEYS_R1 + """cd_cco_base:s nr_div_cco:s cd_matricula:i cd_fornecedor:i cd_multi_empresa:i tp_reembolso:s
    cd_controle_interno:i sn_quitar_mensalidade:s ds_prestador:s dt_atendimento:t dt_alta:t vl_total_original:m
    dt_inclusao:d cd_usuario_inclusao:s dt_ultima_atualizacao:d cd_usuario_ultima_atualizacao:s dt_vencimento:d
    tp_pessoa:s tp_status:s ds_municipio:s sn_notificado:s sn_recusado:s ds_consideracoes_internas:s tp_status_reembolso:s"""
entry("r10_reimbursement_header", "o_head", HEAD)(lambda t: t.draft)
ITEM_KEYS = "cd_reembolso:i cd_ressarcimento_sus:i nr_atendimento:i cd_cco:i nm_municipio:s cd_uf:s nm_ups:s "
entry("r11_reimbursement_items", "o_reimb_item", ITEM_KEYS + """cd_procedimento:i cd_procedimento_mapeado:i
    vl_procedimento:m qt_cobrado:i vl_cobrado:m cd_usuario_inclusao:s dt_usuario_inclusao:d""")(
    lambda t: t.job["reimbursement_item"]
)
entry("r12_reimbursement_denials", "o_denial",
      ITEM_KEYS + "cd_procedimento:i cd_motivo:i cd_usuario_inclusao:s dt_usuario_inclusao:d")(
    lambda t: t.job["reimbursement_denial"]
)
entry("r13_back_link", "o_linked", "cd_item_ressarciment_sus_anexo:i sn_confirmar:s cd_reembolso:i")(
    lambda t: t.job["item"]
)
entry("r14_confirm_items", "o_confirmed", "cd_item_ressarciment_sus_anexo:i vl_procedimento:m sn_confirmar:s")(
    lambda t: r.confirm_items(t["item"], t["staging"], "N")
)
entry("r15_summary_unconfirmed", "o_summary_any", SUMMARY)(lambda t: t.summary(False))
entry("r15_notes_unconfirmed", "o_notes_any", KEYS_ATT + "ds_atendimento:s")(
    lambda t: r.attendance_notes(*t.base, only_confirmed=False)
)
entry("r15_items_unconfirmed", "o_lines_any", LINES)(lambda t: t.lines(False))
entry("r15_critiques_unconfirmed", "o_critiques_any", CRITIQUES)(lambda t: t.critiques(False))

# --- notice screens ---------------------------------------------------------------

entry("v1_item_listing", "o_listing", """cd_item_ressarciment_sus_anexo:i cd_ressarcimento_sus_anexo:i nm_ups:s
    nm_municipio:s cd_uf:s nr_atendimento:i dt_inicio:t dt_fim:t cd_matricula:i cd_mat_alternativa:s nm_segurado:s
    cd_cco:s cd_procedimento:i vl_procedimento:m ds_atendimento:s vl_total:m cd_ressarcimento_sus:i tp_validacao:s
    sn_confirmar:s tp_procedimento:s""")(lambda t: v.item_listing(t["item"], t["member"], t["validation"]))
entry("v2_validation_listing", "o_validations", """cd_valida_item_ress_sus_anexo:i cd_item_ressarciment_sus_anexo:i
    tp_validacao:s ds_mensagem:s dt_validacao:t ds_validacao:s""")(
    lambda t: v.validation_listing(t["validation"], t["item"], t["notice"])
)
entry("v3_notice_list", "o_notices", "cd_ressarcimento_sus:i dt_oficio:d cd_multi_empresa:i")(
    lambda t: v.notice_list(t["notice"], TENANT)
)
entry("v4_attachments", "o_attach", "cd_ressarcimento_sus_anexo:i cd_ressarcimento_sus:i ds_arquivo:s")(
    lambda t: v.attachments(t["notice"], t["attach"])
)
entry("v5_history", "o_history", "cd_historico_ressarcimento_sus:i cd_ressarcimento_sus:i ds_observacao:s")(
    lambda t: v.history(t["notice"], t["history"])
)
entry("v6_document_types", "o_doctype", "cd_tip_doc:i ds_tip_doc:s")(
    lambda t: v.active_values(t["doctype"], "cd_tip_doc", "ds_tip_doc")
)
entry("v7_suppliers", "o_supplier", "cd_fornecedor:i nm_fornecedor:s")(
    lambda t: v.active_values(t["supplier"], "cd_fornecedor", "nm_fornecedor")
)
entry("v8_status_totals", "o_status", "cd_ressarcimento_sus:i " + " ".join(
    f"nr_reembolsos{x}:i vl_cobrado{x}:m vl_pagar{x}:m vl_glosado{x}:m" for x in ("", "_e", "_c", "_n")
))(lambda t: v.status_totals(t["reimb"], t["reimb_item"]))
entry("v9_attendance_total", "o_attendance_total", "cd_ressarcimento_sus:i vl_atendimentos:m")(
    lambda t: v.attendance_total(t["item"])
)
entry("v10_item_severity", "o_severity", "cd_item_ressarciment_sus_anexo:i nr_gravidade:i ds_cor:s")(
    lambda t: v.item_severity(t["validation"])
)

# --- message headers --------------------------------------------------------------

entry("h1_message_fields", "h_msg", """id:i dt_mensagem:t cd_versao_lida:s nr_registro_destino:s nr_cnpj_destino:s
    cd_prestador_enviado:s nr_documento_prestador:s nr_registro_origem:s nr_ip_remetente:s g_data_cd:s g_data_ds:s""")(
    lambda t: t.read
)
entry("h2_check_version", "h_version", "id:i cd_versao_lida:s g_versao_cd:s g_versao_ds:s")(
    lambda t: h.check_version(t.read)
)
entry("h3_resolve_plan", "h_plan", """id:i nr_registro_ans:i cd_multi_empresa:i nr_cnpj_operadora:s ds_operadora:s
    g_operadora_cd:s g_operadora_ds:s""")(lambda t: h.resolve_plan(h.check_version(t.read), t["insurer"], t["company"]))
entry("h4_check_tenant", "h_plan", "id:i plano_achado:b cd_multi_empresa:i g_empresa_cd:s g_empresa_ds:s")(
    lambda t: t.planned
)
entry("h5_resolve_provider", "h_provider", "id:i nr_prestadores:i cd_prestador_cabecalho:i tp_situacao:s")(
    lambda t: t.provided
)
entry("h6_provider_verdict", "h_gone", "id:i nr_prestadores:i g_prestador_cd:s g_prestador_ds:s")(
    lambda t: h.provider_verdict(t.provided)
)
entry("h7_termination_verdict", "h_gone", "id:i dt_desligamento:d g_desligamento_cd:s g_desligamento_ds:s")(
    lambda t: h.termination_verdict(t.provided, t["termination"], AS_OF)
)
entry("h8_needs_credentials", "h_cred", "id:i sn_exige_senha:b")(lambda t: t.resolved)
entry("h9_match_credentials", "h_cred", "id:i sn_senha_prestador:s")(lambda t: t.matched())
entry("h10_network_login", "h_cred", "id:i sn_senha_rede:s sn_senha_rede_fix:s")(
    lambda t: h.network_login(
        h.network_login(t.resolved, t["config"], True).withColumnRenamed("sn_senha_rede", "sn_senha_rede_fix"), t["config"]
    )
)
entry("h11_earlier_credentials", "h_cred_old", "id:i sn_senha_prestador:s")(lambda t: t.matched(False))
VERDICT = """id:i cd_prestador_cabecalho:i nr_registro_ans:i cd_multi_empresa:i nr_cnpj_operadora:s ds_operadora:s
    cd_glosa:s ds_glosa:s"""
entry("h12_header_verdict", "h_verdict", VERDICT)(
    lambda t: validate_headers(
        t["message"], t["insurer"], t["company"], t["provider"], t["termination"], t["address"], t["address_authoriser"],
        t["authoriser"], t["config"], AS_OF, TENANT
    )
)

# --- account-analysis statement ---------------------------------------------------

REQ = "cd_tiss_demnstrv_retorno:i "
entry("a1_requests", "o_request", REQ + """id:i tp_demonstrativo:s cd_versao:s cd_prestador_contratado:i
    dt_competencia:s dt_pagamento:d dt_solicitacao:d""")(lambda t: t.asked)
entry("a2_contracted_provider", "o_body", REQ + """nr_prestadores:i cd_prestador:i nm_prestador:s
    tp_credenciamento:s nr_cnes:i b_cd:s b_ds:s""")(
    lambda t: a.body_verdict(t.contracted).select(
        "*", F.col("g_corpo.cd_glosa").alias("b_cd"), F.col("g_corpo.ds_glosa").alias("b_ds")
    )
)
entry("a3_requested_protocols", "o_proto", REQ + "nr_protocolo:i cd_prestador:i")(
    lambda t: a.requested_protocols(t.fine, t["req_proto"])
)
entry("a4_protocol_verdict", "o_pv", REQ + """nr_protocolo:i cd_lote:i nr_lote_prestador:i dt_envio_lote:t
    cd_status_protocolo:i g_protocolo_cd:s g_protocolo_ds:s""")(lambda t: t.judged)
entry("a5_protocol_totals", "o_pt", REQ + """nr_protocolo:i cd_status_final:i cd_motivo_glosa:s ds_motivo_glosa:s
    vl_informado_protocolo:m vl_processado_protocolo:m vl_protocolo:m vl_glosa_protocolo:m""")(lambda t: t.totals)
GUIDE = "nr_protocolo:i cd_prestador:i cd_guia_externa:s nr_guia:i "
entry("a6_guide_totals", "o_guide", GUIDE + """nm_beneficiario:s nr_carteira:s dt_inicio_fat:t dt_fim_fat:t
    dt_realizacao:t nm_contratado:s sn_atendimento_recem_nato:s sn_liberado:s cd_status_guia:i vl_processado:m
    vl_liberado:m vl_glosado:m vl_informado:m""")(
    lambda t: a.guide_totals(t.rows, t["guide"], t["member"], t["provider"])
)
entry("a7_released_flag", "o_released", "cd_conta_medica:i cd_lote:i")(lambda t: a.released_flag(t.rows))
entry("a8_guide_paid", "o_gpaid", GUIDE + "vl_liberado:m")(lambda t: a.guide_paid(t.inner, t.rows))
entry("a9_payee", "o_payee", "cd_conta_medica:i cd_lancamento:i cd_prestador_pago:i")(
    lambda t: t["claim"].withColumn("cd_prestador_pago", payee(F.col("cd_prestador_principal"), F.col("cd_prestador")))
)
PROC = GUIDE + "cd_lancamento:i dt_realizado:t cd_procedimento:i ds_procedimento:s cd_motivo:i cd_atividade_medica:i "
VALUES = "vl_informado:m vl_liberado:m vl_glosa:m qt_executada:m"
entry("a10_guide_procedures", "o_proc", PROC + VALUES)(lambda t: t.procs)
entry("a11_procedure_table", "o_proct", PROC + "cd_tipo_tabela:s")(
    lambda t: a.procedure_table(t.procs, {c: t[f"proctable_{c}"] for c in PROCEDURE_TABLES})
)
entry("a12_denial_reason", "o_reason", PROC + "cd_motivo_glosa:s ds_motivo_glosa:s vl_glosa:m")(
    lambda t: a.denial_reason(t.procs, t["reason"])
)
entry("a13_hour_text", "o_hours", "cd_conta_medica:i cd_lancamento:i hr_entrada:s hr_saida:s")(
    lambda t: t["claim"].select(
        "cd_conta_medica", "cd_lancamento", hour_text(F.col("dt_entrada")).alias("hr_entrada"),
        hour_text(F.col("dt_saida")).alias("hr_saida"),
    )
)
GENERAL = "vl_informado_geral:m vl_processado_geral:m vl_liberado_geral:m vl_glosa_geral:m"
entry("a14_statement_totals", "o_stot", REQ + GENERAL)(lambda t: a.statement_totals(t.fine, t.totals))
ERROR = REQ + "id:i cd_motivo_glosa:s ds_motivo_glosa:s"
entry("a15_error_rows", "j_error_ana", ERROR)(
    lambda t: a.error_rows(
        a.body_verdict(
            a.contracted_provider(t.gated.filter(F.col("ds_destino") == "ANALISE"), t["provider"], t["address"])
        )
    )
)
HEADS = REQ + """id:i nr_registro_ans:i ds_operadora:s nr_cnpj_operadora:s dt_emissao:s cd_prestador:i ds_prestador:s
    nr_cnes_prestador:i """
entry("a16_statement_rows", "j_stot", HEADS + GENERAL)(lambda t: t.analysis("statement"))
entry("a16_protocol_rows", "j_out_proto", REQ + """nr_lote:i nr_protocolo:i dt_envio_lote:s cd_motivo_glosa_protocolo:s
    ds_motivo_glosa:s cd_status_protocolo:i vl_informado_protocolo:m vl_processado_protocolo:m vl_protocolo:m
    vl_glosa_protocolo:m""")(lambda t: t.analysis("protocol"))
LINE = REQ + "nr_protocolo:i nr_guia_prestador:s nr_guia_operadora:i nm_beneficiario:s "
entry("a16_guide_rows", "j_out_guide", LINE + """nr_senha:i nr_numero_carteira:s dt_inicio_fat:t hr_inicio_fat:s
    dt_fim_fat:t hr_fim_fat:s cd_status_protocolo:i vl_informado_guia:m vl_processado_guia:m vl_liberado_guia:m
    vl_glosa_guia:m""")(lambda t: t.analysis("guide"))
UNDER = LINE + "nr_carteira:s dt_inicio_fat:t dt_fim_fat:t dt_realizacao:t cd_status_guia:i cd_lancamento:i "
entry("a16_procedure_rows", "j_out_proc", UNDER + """dt_execucao:t cd_tipo_tabela:s cd_procedimento:i ds_procedimento:s
    cd_grau_participacao:i vl_informado:m qt_executada:m vl_processado:m vl_liberado:m""")(
    lambda t: t.analysis("procedure")
)
entry("a16_denial_rows", "j_out_denial", UNDER + "cd_procedimento:i cd_motivo_glosa:s ds_motivo_glosa:s vl_glosa:m")(
    lambda t: t.analysis("denial")
)

ABOVE_GUIDE = ("analysis_guide", "id_pai"), ("analysis_protocol", "cd_tiss_dem_ana"), ("analysis_statement", "id_pai")


def named(rows: DataFrame, depth: int, *cols: str) -> list:
    return [F.col(f"{c}_{depth}").alias(c) for c in cols]


@entry("s3_stored_procedures", "j_stored_proc", """id:i nr_protocolo:i nr_guia_prestador:s nr_guia_operadora:i nm_beneficiario:s
    dt_inicio_fat:t vl_liberado_guia:m dt_realizacao:t cd_tipo_tabela:s cd_procedimento:i ds_procedimento:s vl_informado:m
    qt_executada:m vl_processado:m vl_liberado:m""")
def _(t):
    rows = t.stored(("analysis_procedure", "id_pai"), *ABOVE_GUIDE)
    guide = ("nr_guia_prestador", "nr_guia_operadora", "nm_beneficiario", "dt_inicio_fat", "vl_liberado_guia")
    own = ("dt_realizacao", "cd_tipo_tabela", "cd_procedimento", "ds_procedimento", "vl_informado", "qt_executada", "vl_processado", "vl_liberado")
    return rows.select("id", *named(rows, 0, *own), *named(rows, 1, *guide), *named(rows, 2, "nr_protocolo"))


@entry("s3_stored_denials", "j_stored_denial", """id:i nr_protocolo:i nr_guia_operadora:i cd_procedimento:i cd_motivo_glosa:s
    ds_motivo_glosa:s vl_glosa:m""")
def _(t):
    rows = t.stored(("analysis_denial", "id_pai"), ("analysis_procedure", "id_pai"), *ABOVE_GUIDE)
    return rows.select(
        "id", *named(rows, 0, "cd_motivo_glosa", "ds_motivo_glosa", "vl_glosa"), *named(rows, 1, "cd_procedimento"),
        *named(rows, 2, "nr_guia_operadora"), *named(rows, 3, "nr_protocolo"),
    )


@entry("s3_stored_summaries", "j_stored_summary", """id:i dt_pagamento:d vl_total_info_item:m dt_protocolo:t nr_protocolo:i nr_lote:i
    vl_informado:m vl_processado:m vl_liberado:m vl_glosa:m""")
def _(t):
    rows = t.stored(("payment_summary", "id_pai"), ("payment_item", "id_pai"), ("payment_statement", "id_pai"))
    own = ("dt_protocolo", "nr_protocolo", "nr_lote", "vl_informado", "vl_processado", "vl_liberado", "vl_glosa")
    return rows.select("id", *named(rows, 0, *own), *named(rows, 1, "dt_pagamento", "vl_total_info_item"))


@entry("s3_stored_credits", "j_stored_credit", """id:i dt_pagamento:d vl_total_geral_informado:m tp_indicador:i tp_debito_credito:s
    ds_debito_credito:s vl_debito_credito:m""")
def _(t):
    rows = t.stored(("payment_item_credit", "cd_tiss_dem_pgt_item"), ("payment_item", "id_pai"), ("payment_statement", "id_pai"))
    own = ("tp_indicador", "tp_debito_credito", "ds_debito_credito", "vl_debito_credito")
    return rows.select("id", *named(rows, 0, *own), *named(rows, 1, "dt_pagamento"), *named(rows, 2, "vl_total_geral_informado"))


@entry("s3_stored_errors", "j_errors", "id:i cd_motivo_glosa:s ds_motivo_glosa:s")
def _(t):
    rows = t.stored(("error", "cd_tiss_mensagem"))
    return rows.select("id", *named(rows, 0, "cd_motivo_glosa", "ds_motivo_glosa"))


# --- payment statement ------------------------------------------------------------

entry("p1_parse_period", "o_period", REQ + "dt_competencia:s nr_periodo:s dt_dia:d g_periodo_cd:s g_periodo_ds:s")(
    lambda t: t.periods
)
DATE = REQ + "dt_pagamento_feito:d ramo:s "
entry("p2_payment_dates", "o_dates", DATE + "cd_prestador:i tp_credenciamento:s")(lambda t: t.dates)
ITEM = DATE + "cd_itcon_pag:i folha:s "
entry("p3_payment_items", "o_items", ITEM + "cd_con_pag:i cd_prestador:i")(lambda t: t.items)
entry("p4_payment_form", "o_form", "cd_itcon_pag:i tp_forma_pagamento:s")(lambda t: p.payment_form(t["payment"]))
entry("p5_payment_bank", "o_bank", "cd_itcon_pag:i cd_banco:i")(
    lambda t: p.payment_bank(t["payment"], t.of_supplier, t["bank"])
)
entry("p6_payment_agency", "o_agency", "cd_itcon_pag:i cd_agencia:s")(
    lambda t: p.payment_agency(t["payment"], t.of_supplier)
)
entry("p7_payment_account", "o_account", "cd_itcon_pag:i nr_conta:s")(
    lambda t: p.payment_account(t["payment"], t.of_supplier)
)
entry("p8_cheque_override", "o_cheque", "cd_itcon_pag:i nr_conta:s nr_conta_cheque:s")(
    lambda t: p.cheque_override(
        t["payable_item"].select("cd_itcon_pag").join(
            p.payment_account(t["payment"], t.of_supplier), "cd_itcon_pag", "left"
        ),
        t["payment"],
    )
)
SUMS = "vl_informado:m vl_liberado:m vl_glosa:m"
entry("p9_transfer_summary", "o_summary_pay", "cd_repasse_prestador:i folha:s dt_protocolo:t nr_protocolo:i nr_lote:i " + SUMS)(
    lambda t: t.transfer_sums
)
entry("p10_transfers_of", "o_transfers", "cd_con_pag:i cd_repasse_prestador:i cd_fatura:i folha:s")(
    lambda t: p.transfers_of(t.items, t["transfer"])
)
CREDIT = "tp_indicador:i tp_debito_credito:s "
entry("p11_credits_debits", "o_credits", ITEM + "cd_fatura:i " + CREDIT + "ds_observacao:s vl_lancamento:m")(
    lambda t: t.credits
)
entry("p12_item_totals", "o_carried", ITEM + SUMS + " vl_debitos:m vl_creditos:m")(lambda t: t.item_totals())
entry("p12_item_totals_per_item", "o_plain", ITEM + SUMS + " vl_debitos:m vl_creditos:m")(lambda t: t.item_totals(True))
entry("p13_payment_totals", "o_ptot", REQ + SUMS + " vl_debitos:m vl_creditos:m")(
    lambda t: p.payment_totals(t.dates, t.item_totals())
)
entry("p14_statement_credits", "o_out_stat_credit", REQ + "dt_pagamento_feito:d cd_itcon_pag:i " + CREDIT + "ds_db_cr:s vl_db_cr:m")(
    lambda t: p.statement_credits(t.credits)
)
entry("p15_own_network", "o_ownnet", DATE + "cd_prestador:i tp_credenciamento:s tp_forma_pagamento:s")(
    lambda t: p.own_network(t.dates)
)
entry("p16_no_payment_errors", "o_nopay", ERROR)(lambda t: p.no_payment_errors(t.payable_requests, t.dates))
entry("p17_statement_rows", "j_out_stat", HEADS + """vl_total_geral_informado:m vl_total_geral_processado:m
    vl_total_geral_liberado:m vl_total_geral_glosa:m vl_total_debitos_dem:m vl_total_creditos_dem:m vl_liberado_dem:m
    vl_info_bruto:m vl_processado_bruto:m vl_liberado_bruto:m vl_glosa_bruto:m""")(lambda t: t.payment("statement"))
entry("p17_item_rows", "j_out_item", ITEM + """tp_forma_pagamento:s cd_banco:i nr_agencia:s nr_conta_cheque:s
    vl_total_info_item:m vl_total_processado_item:m vl_total_liberado_item:m vl_total_glosa_item:m
    vl_total_debitos_item:m vl_total_creditos_item:m vl_liquido_item:m""")(lambda t: t.payment("item"))
entry("p17_summary_rows", "j_listed", ITEM + """cd_repasse_prestador:i dt_protocolo:t nr_protocolo:i nr_lote:i
    vl_informado:m vl_processado:m vl_liberado:m vl_glosa:m""")(lambda t: t.payment("summary"))
entry("p17_item_credit_rows", "j_out_credit", ITEM + CREDIT + "ds_debito_credito:s vl_debito_credito:m")(
    lambda t: t.payment("item_credit")
)
entry("p17_error_rows", "j_error_pay", ERROR)(lambda t: t.payment("error"))

# --- dispatch and ledger ----------------------------------------------------------

entry("d1_service_gate", "j_gated", REQ + "id:i tp_demonstrativo:s g_cd:s g_ds:s")(
    lambda t: t.gated.select(
        "*", F.col("g_cabecalho.cd_glosa").alias("g_cd"), F.col("g_cabecalho.ds_glosa").alias("g_ds")
    )
)
entry("d2_route", "j_gated", REQ + "id:i ds_destino:s")(lambda t: t.gated)
entry("d3_provider_fallback", "j_gated", REQ + "cd_prestador_resposta:s nr_cnpj_resposta:s nr_cpf_resposta:s")(
    lambda t: t.gated
)
entry("d4_reply_header", "j_reply", REQ + """cd_tiss_mensagem_origem:i tp_transacao:s nm_xml:s nr_registro_ans:s
    nr_cnpj_operadora:s cd_versao:s cd_prestador:s nr_cnpj_prestador:s nr_cpf_prestador:s cd_glosa:s ds_glosa:s""")(
    lambda t: d.reply_header(t.gated)
)
entry("d5_error_log", "f_log", "cd_tiss_mensagem_log:i cd_tiss_mensagem:i dt_log:d ds_log:s")(
    lambda t: d.error_log(t.numbered, AS_OF)
)
entry("d5_error_replies", "f_error", ERROR)(lambda t: d.error_replies(t.numbered))
entry("d5_failed_replies", "f_reply", REQ + """cd_tiss_mensagem_origem:i nr_registro_ans:s cd_versao:s cd_prestador:s
    cd_glosa:s ds_glosa:s""")(lambda t: d.failed_replies(t.numbered, t["config"], TENANT))
entry("d5_all_errors", "j_errors", ERROR)(lambda t: st.statements(t, AS_OF, TENANT)["error"])
entry("d6_provider_valid", "o_valid", REQ + "sn_prestador_valido:s")(lambda t: a.provider_valid(t.asked, t["provider"]))
entry("c1_account_name", "o_account_name", "id:i ds_conta:s")(
    lambda t: c.account_name(t["account_request"], t["chart"], t["closed_month"], t["ledger"], TENANT)
)
