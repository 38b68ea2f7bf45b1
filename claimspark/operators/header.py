"""Message-header validation: one verdict per message, the first failing rule wins."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimspark.functions import blank_to_null, digits, joined, lenient_time, number_text, verdict
from claimspark.operators.picks import both_large, look_up, match_count
from claimspark.sources.tables import config

# Accepted message versions: fixed values.
VERSIONS = [
    "3.05.01", "3.05.00", "3.04.01", "3.04.00", "3.03.03", "3.03.02", "3.03.01", "3.03.00",
    "3.02.02", "3.02.01", "3.02.00", "3.01.00", "2.02.03", "2.02.02", "2.02.01", "2.01.03",
]
LAST_SLASH_DATE_VERSION = "2.01.03"
FIRST_CHECKED_VERSION = "3.01.00"

# Verdict texts as the receivers know them, question marks included: fixed values.
BAD_DATE = "ERRO AO PROCESSAR DADOS DA MENSAGEM TISS. ERRO; "
BAD_VERSION = (
    "VERSAO TISS INVALIDA. APENAS AS VERSOES 3.04.01, 3.04.00, 3.03.03, 3.03.02, 3.03.01, 3.03.00, 3.02.02, "
    "3.02.01, 3.02.00, 3.01.00 , 2.02.03, 2.02.02, 2.02.01 e 02.01.03 S?O ACEITAS"
)
NO_COMPANY = "DESTINATARIO INVALIDO - CNPJ DA OPERADORA N?O IDENTIFICADO"
NO_REGISTRY = "DESTINATARIO INVALIDO - NUMERO DE REGISTRO DA OPERADORA NA ANS INVALIDO"
NO_TENANT = "CODIGO MULTI_EMPRESA NAO CONFIGURADO. ENTRE EM CONTATO COM A OPERADORA"
NO_PROVIDER = "CODIGO PRESTADOR INVALIDO OU INATIVO [NO ORIGEM]"
LEFT_PROVIDER = "PRESTADOR INATIVO. ENTRE EM CONTATO COM A OPERADORA [NO ORIGEM]"
MANY_PROVIDERS = "CODIGO PRESTADOR [NO ORIGEM] COM MAIS DE UM REGISTRO. ENTRE EM CONTATO COM A OPERADORA"
BAD_LOGIN = "REMETENTE N?O IDENTIFICADO - LOGIN OU SENHA do PRESTADOR INVALIDOS"

CHECK_LOGIN_KEY = "WEBSERVICE_VALIDA_LOGIN_SENHA"
MD5_KEY = "WEBSERVICE_SENHA_MD5"
# Order of the fields in a message's date and hour, now and in the older versions.
TIME, OLD_TIME = "YMDhms", "DMYhm"
NETWORK_LOGIN_KEY = "TISS_LOGIN_UNIMED"
NETWORK_SECRET_KEY = "TISS_SENHA_UNIMED"


def transaction_time(form: str) -> Column:
    """(ts, cause) of the date and hour that a message was sent with."""
    return lenient_time(joined(F.col("dt_transacao"), F.lit(" "), F.substring("hr_transacao", 1, 8)), form)


def message_fields(messages: DataFrame, as_of: date) -> DataFrame:
    """The fields the rules read, cleaned. A date that cannot be read blanks them all."""
    sent = F.col("dt_transacao").isNotNull() | F.col("hr_transacao").isNotNull()
    parsed = F.when(
        F.col("cd_versao") <= LAST_SLASH_DATE_VERSION, transaction_time(OLD_TIME)["ts"]
    ).otherwise(transaction_time(TIME)["ts"])
    # a message is costly for its size: the rows of a small file are dealt to all tasks, by the key of the later joins
    dealt = messages.repartition("id")
    document = F.coalesce(
        blank_to_null(F.col("nr_cnpj_prestador_operadora")), blank_to_null(F.col("nr_cpf_prestador_operadora"))
    )
    # cleaned beside the date: within the step of the later joins they made it too long a method to be compiled
    read = dealt.select(
        "*",
        F.when(sent, parsed).otherwise(F.lit(as_of).cast("timestamp_ntz")).alias("dt_mensagem"),
        digits(F.col("nr_registro_ans_destino")).alias("_destino"),
        digits(F.col("nr_cnpj_pagador_destino")).alias("_cnpj"),
        digits(F.col("cd_prestador_operadora")).alias("_enviado"),
        digits(document).alias("_documento"),
        digits(F.col("nr_registro_ans_origem")).alias("_origem"),
    )
    ok = F.col("dt_mensagem").isNotNull()

    def when_read(c: str) -> Column:
        return F.when(ok, F.col(c))

    return read.select(
        "id",
        "dt_mensagem",
        when_read("cd_versao").alias("cd_versao_lida"),
        when_read("_destino").alias("nr_registro_destino"),
        when_read("_cnpj").alias("nr_cnpj_destino"),
        when_read("_enviado").alias("cd_prestador_enviado"),
        when_read("_documento").alias("nr_documento_prestador"),
        when_read("_origem").alias("nr_registro_origem"),
        when_read("ds_login_prestador").alias("ds_login"),
        when_read("ds_senha_prestador").alias("ds_senha_enviada"),
        when_read("nr_ws_ip_remetente").alias("nr_ip_remetente"),
        verdict(~ok, "5013", BAD_DATE).alias("g_data"),
    )


def check_version(df: DataFrame) -> DataFrame:
    """5013 for a version outside the list."""
    return df.withColumn("g_versao", verdict(~F.col("cd_versao_lida").isin(VERSIONS), "5013", BAD_VERSION))


def resolve_plan(df: DataFrame, insurers: DataFrame, companies: DataFrame) -> DataFrame:
    """Operator by registry number or company number; the smallest tenant if both hit.

    An operator has an insurer row and a company row of the same tenant; one without the other is
    not found. A message that failed on its date or version is not looked up.
    """
    plans = insurers.join(companies, "cd_multi_empresa")
    reached = F.col("g_data").isNull() & F.col("g_versao").isNull()
    row = F.struct("cd_multi_empresa", "nr_ans", "cd_cgc", "ds_multi_empresa")
    rules = [
        ([F.when(reached, F.col("nr_registro_destino").try_cast("bigint"))], [F.col("nr_ans")]),
        ([F.when(reached, F.col("nr_cnpj_destino").try_cast("bigint"))], [F.col("cd_cgc")]),
    ]
    found = look_up(df, plans, rules, row, "_plan", "_plan_hi")
    missing = reached & F.col("_plan").isNull()
    text = F.when(F.col("nr_cnpj_destino").isNotNull(), NO_COMPANY).otherwise(NO_REGISTRY)
    return (
        found.withColumn("nr_registro_ans", F.col("_plan.nr_ans"))
        .withColumn("cd_multi_empresa", F.col("_plan.cd_multi_empresa"))
        .withColumn("nr_cnpj_operadora", F.lpad(F.col("_plan.cd_cgc").cast("string"), 14, "0"))
        .withColumn("ds_operadora", F.col("_plan.ds_multi_empresa"))
        .withColumn("g_operadora", verdict(missing, "5004", text))
        .withColumn("plano_achado", F.col("_plan").isNotNull())
        .drop("_plan", "_plan_hi")
    )


def check_tenant(df: DataFrame) -> DataFrame:
    """5013 for an operator without a tenant."""
    return df.withColumn("g_empresa", verdict(F.col("plano_achado") & F.col("cd_multi_empresa").isNull(), "5013", NO_TENANT))


def resolve_provider(df: DataFrame, providers: DataFrame, tenant: int) -> DataFrame:
    """Provider by tax number, internal code, code or intermediary registry, in the tenant.

    ``nr_prestadores`` is 0, 1 or 2 (two or more). With a code sent, the padded tax
    number is compared to the code as sent, without padding.
    """
    own = F.coalesce("cd_multi_empresa", F.lit(tenant))
    code = number_text(F.col("cd_prestador_enviado"))
    of_tenant = F.col("cd_multi_empresa")
    rules = [
        (
            [own, F.coalesce(code, F.lpad("nr_documento_prestador", 14, "0"))],
            [of_tenant, F.lpad(F.col("nr_cpf_cgc").cast("string"), 14, "0")],
        ),
        ([own, code], [of_tenant, F.col("cd_interno")]),
        ([own, code], [of_tenant, F.col("cd_prestador").cast("string")]),
        ([own, F.col("nr_registro_origem")], [of_tenant, F.col("cd_registro_ans_intermed")]),
    ]
    # names that stay clear of the probe's columns while both sides are in scope
    found = look_up(df, providers, rules, F.struct("cd_prestador", "tp_situacao"), "_lo", "_hi")
    return (
        found.withColumn("nr_prestadores", match_count("_lo", "_hi", "cd_prestador"))
        .withColumn("cd_prestador_cabecalho", F.col("_hi.cd_prestador"))
        .withColumn("tp_situacao", F.col("_hi.tp_situacao"))
        .drop("_lo", "_hi")
    )


def provider_verdict(df: DataFrame) -> DataFrame:
    """1203 for no provider or more than one, from version 3.01.00 on."""
    checked = F.col("cd_versao_lida") >= FIRST_CHECKED_VERSION
    none = verdict(checked & (F.col("nr_prestadores") == 0), "1203", NO_PROVIDER)
    many = verdict(checked & (F.col("nr_prestadores") > 1), "1203", MANY_PROVIDERS)
    return df.withColumn("g_prestador", F.coalesce(none, many))


def termination_verdict(df: DataFrame, terminations: DataFrame, as_of: date, days: int = 180) -> DataFrame:
    """1203 for a single inactive provider whose last open termination is past the grace."""
    last = (
        terminations.filter(F.col("dt_reativacao").isNull())
        .groupBy(F.col("cd_prestador").alias("_left_provider"))
        .agg(F.max("dt_desligamento").alias("dt_desligamento"))
    )
    late = (
        (F.col("cd_versao_lida") >= FIRST_CHECKED_VERSION)
        & (F.col("nr_prestadores") == 1)
        & (F.col("tp_situacao") != "A")
        & (F.date_add("dt_desligamento", days) < F.lit(as_of))
    )
    return (
        df.join(last, F.col("cd_prestador_cabecalho") == F.col("_left_provider"), "left")
        .withColumn("g_desligamento", verdict(late, "1203", LEFT_PROVIDER))
        .drop("_left_provider")
    )


def needs_credentials(df: DataFrame, cfg: DataFrame, tenant: int) -> DataFrame:
    """Whether the tenant checks the login of this message."""
    keyed = df.withColumn("_tenant", F.coalesce("cd_multi_empresa", F.lit(tenant)))
    asked = config(keyed, cfg, CHECK_LOGIN_KEY, "N", "_tenant", "_check")
    need = (
        (F.col("cd_versao_lida") >= FIRST_CHECKED_VERSION)
        & (F.col("nr_ip_remetente") != "MV")
        & (F.col("_check") == "S")
    )
    return asked.withColumn("sn_exige_senha", F.coalesce(need, F.lit(False))).drop("_tenant", "_check")


def match_credentials(logins: DataFrame, providers: DataFrame, addresses: DataFrame, links: DataFrame,
                      authorisers: DataFrame, cfg: DataFrame, tenant: int = 1, clean_login: bool = True) -> DataFrame:
    """Whether any secret stored for the provider equals the one sent, plain or hashed.

    ``links`` names the authorisers of each address.
    The secret is part of the join key, so a provider with many authorisers is still
    one lookup. The result keeps no secret, only ``sn_senha_prestador``.
    ``clean_login=False`` is the earlier rule, where the login must be a number.
    """
    stored = (
        providers.select("cd_prestador")
        .join(both_large(addresses.select("cd_prestador", "cd_prestador_endereco")), "cd_prestador")
        .join(both_large(links.select("cd_prestador_endereco", "cd_autorizador")), "cd_prestador_endereco")
        .join(both_large(authorisers.select("cd_autorizador", "ds_senha")), "cd_autorizador")
        .filter(F.col("ds_senha").isNotNull())
    )
    kinds = F.explode(
        F.array(
            F.struct(F.lit("N").alias("tp"), F.col("ds_senha").alias("valor")),
            F.struct(F.lit("S").alias("tp"), F.md5("ds_senha").alias("valor")),
        )
    )
    known = (
        stored.select(F.col("cd_prestador").alias("_k_prest"), kinds.alias("_k"))
        .select("_k_prest", F.col("_k.tp").alias("_k_tp"), F.col("_k.valor").alias("_k_valor"))
        .distinct()
    )
    login = digits(F.col("ds_login")) if clean_login else F.col("ds_login")
    keyed = logins.withColumn("_tenant", F.coalesce("cd_multi_empresa", F.lit(tenant)))
    hashed = config(keyed, cfg, MD5_KEY, "N", "_tenant", "_md5")
    probe = hashed.withColumn("_login", login.try_cast("bigint")).withColumn(
        "_kind", F.when(F.col("_md5") == "S", "S").otherwise("N")
    )
    on = (F.col("_login") == F.col("_k_prest")) & (F.col("_kind") == F.col("_k_tp")) & (
        F.col("ds_senha_enviada") == F.col("_k_valor")
    )
    return (
        probe.join(known, on, "left")
        .withColumn("sn_senha_prestador", F.when(F.col("_k_prest").isNotNull(), "S").otherwise("N"))
        .drop("_tenant", "_md5", "_login", "_kind", "_k_prest", "_k_tp", "_k_valor")
    )


def network_login(logins: DataFrame, cfg: DataFrame, fix: bool = False) -> DataFrame:
    """Whether the sent login and secret are the ones configured for the network.

    As written in the source system the comparison uses a value that is never set, so
    it never holds; ``fix=True`` compares the sent secret, plain or hashed.
    """
    keyed = logins.withColumn("_tenant", F.coalesce("cd_multi_empresa", F.lit(1)))
    both = config(config(keyed, cfg, NETWORK_LOGIN_KEY, None, "_tenant", "_login"), cfg, NETWORK_SECRET_KEY, None,
                  "_tenant", "_secret")
    full = config(both, cfg, MD5_KEY, "N", "_tenant", "_md5")
    sent = F.when(F.col("_md5") == "S", F.md5("ds_senha_enviada")).otherwise(F.col("ds_senha_enviada"))
    hit = (F.col("_login") == F.col("ds_login")) & (sent == F.col("_secret")) if fix else F.lit(False)
    return full.withColumn("sn_senha_rede", F.when(hit, "S").otherwise("N")).drop("_tenant", "_login", "_secret", "_md5")


def header_verdict(df: DataFrame) -> DataFrame:
    """First failing rule of a message, with what was resolved up to then."""
    bad_login = verdict(
        F.col("sn_exige_senha") & (F.col("sn_senha_prestador") == "N") & (F.col("sn_senha_rede") == "N"),
        "5005",
        BAD_LOGIN,
    )
    first = F.coalesce(
        "g_data", "g_versao", "g_operadora", "g_empresa", "g_prestador", "g_desligamento", bad_login
    )
    return df.withColumn("_first", first).select(
        "id",
        "cd_prestador_cabecalho",
        "nr_registro_ans",
        "cd_multi_empresa",
        "nr_cnpj_operadora",
        "ds_operadora",
        F.col("_first.cd_glosa").alias("cd_glosa"),
        F.col("_first.ds_glosa").alias("ds_glosa"),
    )
