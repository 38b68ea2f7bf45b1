"""Routing of statement requests: service gate, reply header, failures."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimspark.functions import joined, verdict
from claimspark.operators.analysis import REQUEST
from claimspark.operators.header import TIME, transaction_time
from claimspark.sources.tables import config

# Codes and texts: fixed values.
SERVICE_KEY = "WEBSERVICE_DEMONST_RETORNO"
VERSION_KEY = "VERSAO_TISS"
PAYMENT_TYPES = ["1"]
ANALYSIS_TYPES = ["2", "3"]
NO_REGISTRY = "999999"
PAYMENT_REPLY = ("DEMONSTRATIVO_PAGAMENTO", "demonstrativoPagamento")
ANALYSIS_REPLY = ("DEMONSTRATIVO_ANALISE_CONTA", "demonstrativoAnaliseConta")
SERVICE_OFF = "WEB SERVICE DEMONSTRATIVO RETORNO NÃO ESTÁ ATIVO - ENTRE EM CONTATO COM A OPERADORA"
NO_TYPE = "NÃO FOI INFORMADO UM TIPO DE DEMONSTRATIVO NA SOLICITAÇÃO"
FAILED = "OCORREU UM ERRO NO PROCESSAMENTO DA SUA REQUISIÇÃO. ERRO CÓD: "
LOGGED = "ERRO: DATA/HORA DA TRANSACAO INVALIDA"


def service_gate(df: DataFrame, cfg: DataFrame) -> DataFrame:
    """5013 where the tenant's service is off, then where no statement type was sent.

    Adds ``g_cabecalho``: the header's own verdict first. Needs the columns of
    ``header_verdict`` and the request's type.
    """
    own = F.when(F.col("cd_glosa").isNotNull(), F.struct("cd_glosa", "ds_glosa"))
    switched = config(df, cfg, SERVICE_KEY, "N", "cd_multi_empresa", "_switch")
    off = verdict(F.upper("_switch") == "N", "5013", SERVICE_OFF)
    untyped = verdict(F.col("tp_demonstrativo").isNull(), "5013", NO_TYPE)
    return switched.withColumn("g_cabecalho", F.coalesce(own, off, untyped)).drop("_switch")


def route(df: DataFrame) -> DataFrame:
    """Where a request goes, by its type alone: PAGAMENTO, ANALISE or ERRO."""
    kind = (
        F.when(F.col("tp_demonstrativo").isin(PAYMENT_TYPES), "PAGAMENTO")
        .when(F.col("tp_demonstrativo").isin(ANALYSIS_TYPES), "ANALISE")
        .otherwise("ERRO")
    )
    return df.withColumn("ds_destino", kind)


def provider_fallback(df: DataFrame) -> DataFrame:
    """Provider of the reply: the resolved one, else the ids as sent."""
    unknown = F.col("cd_prestador_cabecalho").isNull()
    return df.select(
        "*",
        F.coalesce(F.col("cd_prestador_cabecalho").cast("string"), F.col("cd_prestador_operadora")).alias(
            "cd_prestador_resposta"
        ),
        F.when(unknown, F.col("nr_cnpj_prestador_operadora")).alias("nr_cnpj_resposta"),
        F.when(unknown, F.col("nr_cpf_prestador_operadora")).alias("nr_cpf_resposta"),
    )


def reply_header(df: DataFrame) -> DataFrame:
    """One reply row per request, from the routed frame with ``provider_fallback``."""
    analysis = F.col("ds_destino") == "ANALISE"

    def either(i: int) -> Column:
        return F.when(analysis, ANALYSIS_REPLY[i]).otherwise(PAYMENT_REPLY[i])

    return df.select(
        REQUEST,
        F.col("id").alias("cd_tiss_mensagem_origem"),
        either(0).alias("tp_transacao"),
        either(1).alias("nm_xml"),
        F.coalesce(F.col("nr_registro_ans").cast("string"), F.col("nr_registro_ans_destino"), F.lit(NO_REGISTRY)).alias(
            "nr_registro_ans"
        ),
        "nr_cnpj_operadora",
        "cd_versao",
        F.col("cd_prestador_resposta").alias("cd_prestador"),
        F.col("nr_cnpj_resposta").alias("nr_cnpj_prestador"),
        F.col("nr_cpf_resposta").alias("nr_cpf_prestador"),
        F.col("g_cabecalho.cd_glosa").alias("cd_glosa"),
        F.col("g_cabecalho.ds_glosa").alias("ds_glosa"),
    )


def failed_requests(req: DataFrame) -> DataFrame:
    """Requests the statement job cannot read, with the cause: their date is not in the one form it takes."""
    sent = F.col("dt_transacao").isNotNull() | F.col("hr_transacao").isNotNull()
    read = req.withColumn("_time", transaction_time(TIME))
    return read.filter(sent & F.col("_time.ts").isNull()).withColumn("ds_causa", F.col("_time.cause")).drop("_time")


def readable_requests(req: DataFrame) -> DataFrame:
    unsent = F.col("dt_transacao").isNull() & F.col("hr_transacao").isNull()
    return req.filter(unsent | transaction_time(TIME)["ts"].isNotNull())


def failed_replies(numbered: DataFrame, cfg: DataFrame, tenant: int) -> DataFrame:
    """Reply row of each failed request, in the tenant's current message version."""
    versioned = config(
        numbered.withColumn("_tenant", F.lit(tenant).cast("bigint")), cfg, VERSION_KEY, None, "_tenant", "_version"
    )
    none = F.lit(None).cast("string")
    text = joined(F.lit(FAILED), F.col("cd_tiss_mensagem_log"))
    return versioned.select(
        REQUEST, F.col("id").alias("cd_tiss_mensagem_origem"), none.alias("tp_transacao"), none.alias("nm_xml"),
        F.lit(NO_REGISTRY).alias("nr_registro_ans"), none.alias("nr_cnpj_operadora"),
        F.col("_version").alias("cd_versao"), F.lit(NO_REGISTRY).alias("cd_prestador"),
        none.alias("nr_cnpj_prestador"), none.alias("nr_cpf_prestador"), F.lit("5013").alias("cd_glosa"),
        text.alias("ds_glosa"),
    )


def error_log(numbered: DataFrame, as_of: date) -> DataFrame:
    """Log row of each failed request, naming the cause. ``numbered`` carries ``cd_tiss_mensagem_log``."""
    return numbered.select(
        "cd_tiss_mensagem_log", F.col("id").alias("cd_tiss_mensagem"), F.lit(as_of).alias("dt_log"),
        F.concat(F.lit(LOGGED), F.lit(": "), F.col("ds_causa")).alias("ds_log"),
    )


def error_replies(numbered: DataFrame) -> DataFrame:
    """Error row of each failed request; it names the log id."""
    return numbered.select(
        REQUEST,
        "id",
        F.lit("5013").alias("cd_motivo_glosa"),
        joined(F.lit(FAILED), F.col("cd_tiss_mensagem_log")).alias("ds_motivo_glosa"),
    )
