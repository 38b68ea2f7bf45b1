"""Payment statement: dates, items, transfer summaries, credits and debits of a request."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimspark.functions import back_to_front_period, joined, money, text_number, verdict
from claimspark.operators.analysis import INVALID_PROVIDER, REQUEST, zero
from claimspark.operators.picks import both_large, first_by
from claimspark.operators.running import running_totals
from claimspark.sources.tables import gate

PAYROLL_KEY = "CONTMED_FOLHA_PGTO"
OWN_NETWORK = "P"

# Codes and texts: fixed values.
FORMS = {"5": "1", "8": "1", "1": "3", "2": "3", "3": "4", "4": "4"}
OWN_NETWORK_FORM = "1"
INDICATORS = {"C": 1, "D": 2}
CREDIT_DEBIT_TYPE = "08"
BAD_PERIOD = "DATA DE COMPETENCIA SOLICITADA INVÁLIDA"
BAD_DAY = "DATA DE PAGAMENTO SOLICITADA INVÁLIDA"
MANY_PROVIDERS = (
    "CÓDIGO PRESTADOR INVÁLIDO/PRESTADOR COM MAIS DE UM REGISTRO. ENTRE EM CONTATO COM A OPERADORA"
)
NO_PAYMENT = "NÃO FORAM ENCONTRADOS PAGAMENTOS NA "

# A date of a request; ``ramo`` tells which of the three sources it came from.
DATE = [REQUEST, "dt_pagamento_feito", "ramo"]
DATED = [REQUEST, "id", "cd_prestador", "cd_multi_empresa", "tp_credenciamento"]
ITEM = [*DATE, "cd_itcon_pag", "folha"]
ITEM_VALUES = ["vl_informado", "vl_liberado", "vl_glosa"]


def unstaged(df: DataFrame) -> DataFrame:
    """For callers that materialise nothing between the steps."""
    return df


def mapped(c: Column, table: dict) -> Column:
    return reduce(lambda acc, kv: acc.when(c == kv[0], kv[1]), list(table.items())[1:],
                  F.when(c == next(iter(table)), next(iter(table.values()))))


def parse_period(req: DataFrame) -> DataFrame:
    """'YYYYMM' -> 'MMYYYY' and a day; a text that is neither gives 5013."""
    period = F.col("dt_competencia")
    month = F.try_to_timestamp(F.concat(period, F.lit("01")), F.lit("yyyyMMdd"))
    day = F.col("dt_pagamento").cast("string").try_cast("date")
    return (
        req.withColumn("nr_periodo", F.when(month.isNotNull(), back_to_front_period(period)))
        .withColumn("dt_dia", day)
        .withColumn("g_periodo", verdict(period.isNotNull() & month.isNull(), "5013", BAD_PERIOD))
        .withColumn("g_dia", verdict(F.col("dt_pagamento").isNotNull() & day.isNull(), "5013", BAD_DAY))
    )


def payment_verdict(df: DataFrame) -> DataFrame:
    """Bad day over bad period over unknown provider over more than one provider."""
    unknown = verdict(F.col("nr_prestadores") == 0, "1203", INVALID_PROVIDER)
    several = verdict(F.col("nr_prestadores") > 1, "1203", MANY_PROVIDERS)
    return df.withColumn("g_corpo", F.coalesce("g_dia", "g_periodo", unknown, several))


def paid_on(payable_items: DataFrame, payments: DataFrame) -> DataFrame:
    """Payment dates of the items of a payable."""
    dated = payments.select("cd_itcon_pag", F.col("dt_pagamento").alias("dt_pagamento_feito"))
    return payable_items.select("cd_itcon_pag", "cd_con_pag").join(both_large(dated), "cd_itcon_pag")


def wanted_transfers(transfers: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return transfers.join(keys.select(key).distinct(), key, "left_semi")


def _match_dates(asked: DataFrame, dates: DataFrame, branch: str, month_only: bool) -> DataFrame:
    """Requests against (provider, tenant, date), by day or by month, as one equi-join.

    A date answers to its day text and to its month text; a request carries the one it
    asked for.
    """
    month = F.date_format("dt_pagamento_feito", "MMyyyy")
    texts = [month] if month_only else [month, F.date_format("dt_pagamento_feito", "yyyy-MM-dd")]
    offered = dates.select(
        F.col("cd_prestador").alias("_prest"),
        F.col("cd_multi_empresa").alias("_tenant"),
        "dt_pagamento_feito",
        F.explode(F.array(*texts)).alias("_when"),
    )
    by_day = F.date_format("dt_dia", "MMyyyy" if month_only else "yyyy-MM-dd")
    probe = asked.withColumn("_asked", F.when(F.col("dt_dia").isNotNull(), by_day).otherwise(F.col("nr_periodo")))
    on = (
        (F.col("cd_prestador") == F.col("_prest"))
        & (F.col("cd_multi_empresa") == F.col("_tenant"))
        & (F.col("_asked") == F.col("_when"))
    )
    return probe.join(both_large(offered), on).select(*DATED, "dt_pagamento_feito", F.lit(branch).alias("ramo"))


def payment_dates(req: DataFrame, transfers: DataFrame, invoices: DataFrame, payables: DataFrame,
                  payable_items: DataFrame, payments: DataFrame, providers: DataFrame, ownpay: DataFrame,
                  cfg: DataFrame) -> DataFrame:
    """Distinct payment dates of a request.

    By invoice where the tenant keeps no payroll; else by payable for contracted
    providers and by own-network month for the own network. ``req`` carries
    provider, tenant and the result of ``parse_period``.
    """
    keep_n, keep_s = gate(req, cfg, PAYROLL_KEY, "N"), gate(req, cfg, PAYROLL_KEY, "S")
    # the payables of the asked providers first: items and payments are joined for these alone
    asked = wanted_transfers(transfers, keep_n.select("cd_prestador").unionByName(keep_s.select("cd_prestador")), "cd_prestador")
    real = payables.select("cd_con_pag").join(asked.select("cd_con_pag").distinct(), "cd_con_pag", "left_semi")
    real = payable_items.join(both_large(real), "cd_con_pag", "left_semi")
    paid = paid_on(real, payments).select("cd_con_pag", "dt_pagamento_feito").distinct()

    billed = (
        wanted_transfers(transfers, keep_n, "cd_prestador")
        .join(invoices, "cd_fatura")
        .select("cd_prestador", "cd_multi_empresa", "cd_con_pag")
        .distinct()
        .join(paid, "cd_con_pag")
        .select("cd_prestador", "cd_multi_empresa", "dt_pagamento_feito")
        .distinct()
    )
    mine = wanted_transfers(transfers, keep_s, "cd_prestador")
    kind = providers.select("cd_prestador", "tp_credenciamento", "cd_multi_empresa")
    contracted = (
        mine.join(kind.filter(F.col("tp_credenciamento") != OWN_NETWORK), "cd_prestador")
        .select("cd_prestador", "cd_multi_empresa", "cd_con_pag")
        .distinct()
        .join(paid, "cd_con_pag")
        .select("cd_prestador", "cd_multi_empresa", "dt_pagamento_feito")
        .distinct()
    )
    own = (
        mine.join(kind.filter(F.col("tp_credenciamento") == OWN_NETWORK), "cd_prestador")
        .join(ownpay, "cd_pagamento_prestador")
        .select("cd_prestador", "cd_multi_empresa", F.col("dt_competencia").alias("dt_pagamento_feito"))
        .distinct()
    )
    return (
        _match_dates(keep_n, billed, "FATURA", False)
        .unionByName(_match_dates(keep_s, contracted, "CONTA", False))
        .unionByName(_match_dates(keep_s, own, "PROPRIA", True))
    )


def payment_items(dates: DataFrame, transfers: DataFrame, invoices: DataFrame, payables: DataFrame,
                  payable_items: DataFrame, payments: DataFrame, providers: DataFrame, cfg: DataFrame) -> DataFrame:
    """Payable items paid on a date, for the providers whose web-guide owner asks.

    Own-network providers, and those of no known kind, have dates but no items.
    """
    asked = dates.filter(F.col("tp_credenciamento") != OWN_NETWORK)
    owners = (
        providers.select("cd_prestador", F.col("cd_prestador_guia_web").alias("_owner"))
        .join(asked.select(F.col("cd_prestador").alias("_owner")).distinct(), "_owner", "left_semi")
    )
    owned = transfers.join(owners, "cd_prestador")
    paid = paid_on(payable_items.join(owned.select("cd_con_pag").distinct(), "cd_con_pag", "left_semi"), payments)
    known = both_large(payables.select("cd_con_pag", F.col("cd_multi_empresa").alias("_tenant")))
    by_invoice = (
        owned.join(invoices.select("cd_fatura", F.col("cd_multi_empresa").alias("_tenant")), "cd_fatura")
        .select("_owner", "_tenant", "cd_con_pag")
        .distinct()
        .join(known.select("cd_con_pag"), "cd_con_pag", "left_semi")
    )
    by_payable = owned.select("_owner", "cd_con_pag").distinct().join(known, "cd_con_pag")
    branches = []
    for payroll, side in (("N", by_invoice), ("S", by_payable)):
        rows = (
            side.join(paid, "cd_con_pag")
            .select("_owner", "_tenant", F.col("dt_pagamento_feito").alias("_dt"), "cd_itcon_pag", "cd_con_pag")
            .distinct()
        )
        on = (
            (F.col("cd_prestador") == F.col("_owner"))
            & (F.col("cd_multi_empresa") == F.col("_tenant"))
            & (F.col("dt_pagamento_feito") == F.col("_dt"))
        )
        branches.append(
            gate(asked, cfg, PAYROLL_KEY, payroll)
            .join(both_large(rows), on)
            .select(*DATED, "dt_pagamento_feito", "ramo", "cd_itcon_pag", "cd_con_pag", F.lit(payroll).alias("folha"))
        )
    return branches[0].unionByName(branches[1])


def payment_form(payments: DataFrame) -> DataFrame:
    """Form code of an item's first payment; an unknown code is NULL."""
    first = first_by(payments, ["cd_itcon_pag"], [F.col("cd_pagcon_pag")], ["tp_pagamento"])
    return first.select("cd_itcon_pag", mapped(F.col("tp_pagamento"), FORMS).alias("tp_forma_pagamento"))


def single_or_null(frames: list[DataFrame], key: str, col: str) -> DataFrame:
    """The value of ``col`` when the sources hold one in all, else NULL.

    Each source counts its distinct values on its own, so the same value in two
    sources is two values. One aggregate over the union does it.
    """
    tagged = [f.select(key, F.col(col).alias("_v"), F.lit(i).alias("_src")) for i, f in enumerate(frames)]
    rows = reduce(DataFrame.unionByName, tagged).filter(F.col("_v").isNotNull())
    ends = [
        agg
        for i in range(len(frames))
        for agg in (
            F.min(F.when(F.col("_src") == i, F.col("_v"))).alias(f"_lo{i}"),
            F.max(F.when(F.col("_src") == i, F.col("_v"))).alias(f"_hi{i}"),
        )
    ]
    per_source = [
        F.when(F.col(f"_lo{i}").isNull(), 0).when(F.col(f"_lo{i}") == F.col(f"_hi{i}"), 1).otherwise(2)
        for i in range(len(frames))
    ]
    only = F.when(reduce(Column.__add__, per_source) == 1, F.coalesce(*[F.col(f"_hi{i}") for i in range(len(frames))]))
    return rows.groupBy(key).agg(*ends).select(key, only.alias(col))


def supplier_of_item(payable_items: DataFrame, payables: DataFrame, suppliers: DataFrame) -> DataFrame:
    return (
        payable_items.select("cd_itcon_pag", "cd_con_pag")
        .join(both_large(payables.select("cd_con_pag", "cd_fornecedor")), "cd_con_pag")
        .join(both_large(suppliers.select("cd_fornecedor", "cd_banco", "cd_agencia", "nr_conta")), "cd_fornecedor")
    )


def payment_bank(payments: DataFrame, of_supplier: DataFrame, banks: DataFrame) -> DataFrame:
    """Bank of an item, from its payments and its supplier."""
    own = payments.select("cd_itcon_pag", F.col("cd_banco_forn").alias("cd_banco"))
    listed = of_supplier.join(banks.select("cd_banco").distinct(), "cd_banco", "left_semi")
    return single_or_null([own, listed], "cd_itcon_pag", "cd_banco")


def payment_agency(payments: DataFrame, of_supplier: DataFrame) -> DataFrame:
    """Branch office of an item."""
    own = payments.select("cd_itcon_pag", F.col("cd_agencia_forn").alias("cd_agencia"))
    return single_or_null([own, of_supplier], "cd_itcon_pag", "cd_agencia")


def payment_account(payments: DataFrame, of_supplier: DataFrame) -> DataFrame:
    """Account number of an item."""
    own = payments.select("cd_itcon_pag", F.col("nr_conta_forn").alias("nr_conta"))
    return single_or_null([own, of_supplier], "cd_itcon_pag", "nr_conta")


def cheque_override(items: DataFrame, payments: DataFrame) -> DataFrame:
    """Account or cheque: one cheque replaces ``nr_conta``, several leave nothing."""
    cheques = (
        payments.filter(F.col("cd_cheque").isNotNull())
        .groupBy("cd_itcon_pag")
        .agg(F.min("cd_cheque").alias("_lo"), F.max("cd_cheque").alias("_hi"))
    )
    value = (
        F.when(F.col("_lo").isNull(), F.col("nr_conta")).when(F.col("_lo") == F.col("_hi"), F.col("_hi"))
    )
    return items.join(cheques, "cd_itcon_pag", "left").withColumn("nr_conta_cheque", value).drop("_lo", "_hi")


def payment_details(payments: DataFrame, payable_items: DataFrame, payables: DataFrame, suppliers: DataFrame,
                    banks: DataFrame) -> DataFrame:
    """Form, bank, branch office and account or cheque per item."""
    of_supplier = supplier_of_item(payable_items, payables, suppliers)
    accounts = payable_items.select("cd_itcon_pag").join(payment_account(payments, of_supplier), "cd_itcon_pag", "left")
    return (
        cheque_override(accounts, payments)
        .drop("nr_conta")
        .join(payment_form(payments), "cd_itcon_pag", "left")
        .join(payment_bank(payments, of_supplier, banks), "cd_itcon_pag", "left")
        .join(payment_agency(payments, of_supplier), "cd_itcon_pag", "left")
    )


def transfers_of(items: DataFrame, transfers: DataFrame) -> DataFrame:
    """All transfers of the items' payables, with the payroll rule to sum them by."""
    wanted = items.select("cd_con_pag", "folha").distinct()
    return transfers.select("cd_con_pag", "cd_repasse_prestador", "cd_fatura").join(wanted, "cd_con_pag")


def transfer_summary(wanted: DataFrame, claims: DataFrame, lots: DataFrame, protocols: DataFrame,
                     batch_guides: DataFrame, stage: Callable[[DataFrame], DataFrame] = unstaged) -> DataFrame:
    """Informed, released and denied value per transfer and protocol.

    ``wanted`` has transfer, invoice and payroll rule. Rule N finds the protocols by
    invoice, rule S by the claims linked to the transfer, where a lot without protocol
    stands for itself. Claims are summed per lot before anything is joined to them.
    ``stage`` materialises what the next large table is joined to: a small side whose size is known spares it its shuffle.
    """
    def informed(of: DataFrame) -> DataFrame:
        return of.groupBy("cd_protocolo_ctamed").agg(
            money(F.sum(text_number(F.col("vl_total_procedimento")))).alias("vl_guias")
        )

    sums = [F.sum("vl_total_pago").alias("pago"), F.sum("vl_total_glosado").alias("glosado")]
    heads = protocols.select("cd_protocolo_ctamed", "dt_envio_lote", "nr_lote_prestador", "cd_fatura")

    wanted = stage(wanted)
    by_invoice = wanted.filter(F.col("folha") == "N").select("cd_repasse_prestador", "cd_fatura", "folha").distinct()
    lots_n = stage(by_invoice.join(heads, "cd_fatura"))
    lots_n = stage(lots_n.join(lots.select("cd_lote", "cd_protocolo_ctamed"), "cd_protocolo_ctamed"))
    guides_n = batch_guides.join(lots_n.select("cd_protocolo_ctamed").distinct(), "cd_protocolo_ctamed", "left_semi")
    per_lot = (
        claims.join(lots_n.select("cd_lote").distinct(), "cd_lote", "left_semi").groupBy("cd_lote").agg(*sums)
    )
    rule_n = (
        lots_n.join(per_lot, "cd_lote")
        .groupBy("cd_repasse_prestador", "folha", "dt_envio_lote", "cd_protocolo_ctamed", "nr_lote_prestador")
        .agg(F.sum("pago").alias("pago"), F.sum("glosado").alias("glosado"))
        .join(informed(guides_n), "cd_protocolo_ctamed", "left")
        .select(
            "cd_repasse_prestador", "folha", F.col("dt_envio_lote").alias("dt_protocolo"),
            F.col("cd_protocolo_ctamed").alias("nr_protocolo"), F.col("nr_lote_prestador").alias("nr_lote"),
            F.col("vl_guias").alias("vl_informado"), money(F.col("pago")).alias("vl_liberado"),
            money(F.col("glosado")).alias("vl_glosa"),
        )
    )
    by_claim = wanted.filter(F.col("folha") == "S").select("cd_repasse_prestador", "folha").distinct()
    lots_s = stage(
        claims.select("cd_repasse_prestador", "cd_lote", "vl_total_pago", "vl_total_glosado")
        .join(by_claim, "cd_repasse_prestador")
        .groupBy("cd_repasse_prestador", "folha", "cd_lote")
        .agg(*sums)
    )
    lots_s = stage(lots_s.join(lots.select("cd_lote", "cd_protocolo_ctamed", "dt_lote"), "cd_lote"))
    listed = lots_s.select("cd_protocolo_ctamed").distinct()
    heads_s, guides_s = (df.join(listed, "cd_protocolo_ctamed", "left_semi") for df in (heads.drop("cd_fatura"), batch_guides))
    rule_s = (
        lots_s.join(heads_s.withColumn("_found", F.lit(True)), "cd_protocolo_ctamed", "left")
        .join(informed(guides_s), "cd_protocolo_ctamed", "left")
        .select(
            "cd_repasse_prestador", "folha", F.coalesce("dt_envio_lote", "dt_lote").alias("dt_protocolo"),
            F.coalesce("cd_protocolo_ctamed", "cd_lote").alias("nr_protocolo"),
            F.coalesce("nr_lote_prestador", "cd_lote").alias("nr_lote"),
            F.coalesce(F.when(F.col("_found"), F.col("vl_guias")), money(F.col("pago"))).alias("vl_informado"),
            money(F.col("pago")).alias("vl_liberado"), money(F.col("glosado")).alias("vl_glosa"),
        )
    )
    return rule_n.unionByName(rule_s)


def summary_rows(items: DataFrame, transfers: DataFrame, summary: DataFrame, *ids: str) -> DataFrame:
    """Transfer summaries listed under each item; processed equals released. ``ids`` of the item come along."""
    links = transfers_of(items, transfers).select("cd_con_pag", "folha", "cd_repasse_prestador")
    per_payable = links.join(summary, ["cd_repasse_prestador", "folha"])
    return items.select(*ids, *ITEM, "cd_con_pag").join(per_payable, ["cd_con_pag", "folha"]).select(
        *ids, *ITEM, "cd_repasse_prestador", "dt_protocolo", "nr_protocolo", "nr_lote", "vl_informado",
        F.col("vl_liberado").alias("vl_processado"), "vl_liberado", "vl_glosa",
    )


def payable_credits(items: DataFrame, transfers: DataFrame, protocols: DataFrame, lots: DataFrame, claims: DataFrame,
                    creddeb: DataFrame, stage: Callable[[DataFrame], DataFrame] = unstaged) -> DataFrame:
    """Credits and debits per payable, of its invoices that have claims behind them; ``stage`` as in ``transfer_summary``."""
    invoices = stage(wanted_transfers(transfers, items, "cd_con_pag").select("cd_con_pag", "cd_fatura").distinct())
    of_invoice = stage(protocols.select("cd_fatura", "cd_protocolo_ctamed").join(
        invoices.select("cd_fatura").distinct(), "cd_fatura", "left_semi"
    ))
    asked_lots = stage(of_invoice.join(lots.select("cd_lote", "cd_protocolo_ctamed"), "cd_protocolo_ctamed"))
    # claims of the asked lots only; distinct then lets a lot with very many claims leave each task as one row
    used_lots = claims.select("cd_lote").join(asked_lots.select("cd_lote"), "cd_lote", "left_semi").distinct()
    claimed = (
        asked_lots.join(used_lots, "cd_lote", "left_semi")
        .select("cd_fatura")
        .distinct()
    )
    return (
        invoices.join(claimed, "cd_fatura", "left_semi")
        .join(creddeb, "cd_fatura")
        .select(
            "cd_con_pag", "cd_fatura", mapped(F.col("tp_lancamento"), INDICATORS).alias("tp_indicador"),
            F.lit(CREDIT_DEBIT_TYPE).alias("tp_debito_credito"), "ds_observacao", "vl_lancamento",
        )
    )


def credits_debits(items: DataFrame, of_payable: DataFrame, *ids: str) -> DataFrame:
    """Credits and debits listed under each item; ``ids`` of the item come along."""
    return items.select(*ids, *ITEM, "cd_con_pag").join(of_payable, "cd_con_pag").drop("cd_con_pag")


def item_totals(items: DataFrame, transfers: DataFrame, summary: DataFrame, of_payable: DataFrame,
                per_item: bool = False, ids: tuple[str, ...] = ()) -> DataFrame:
    """Totals of an item; its ``ids`` come along.

    Informed, released and denied are carried over the items of a date in item order;
    ``per_item=True`` gives each item's own. Debits and credits are always the item's.
    """
    links = transfers_of(items, transfers).select("cd_con_pag", "folha", "cd_repasse_prestador")
    paid = (
        links.join(summary, ["cd_repasse_prestador", "folha"])
        .groupBy("cd_con_pag", "folha")
        .agg(*[F.sum(v).alias(v) for v in ITEM_VALUES])
    )
    adjusted = of_payable.groupBy("cd_con_pag").agg(
        F.sum(F.when(F.col("tp_indicador") == 2, F.col("vl_lancamento"))).alias("vl_debitos"),
        F.sum(F.when(F.col("tp_indicador") == 1, F.col("vl_lancamento"))).alias("vl_creditos"),
    )
    values = [*ITEM_VALUES, "vl_debitos", "vl_creditos"]
    full = (
        items.join(paid, ["cd_con_pag", "folha"], "left")
        .join(adjusted, "cd_con_pag", "left")
        .select(*ids, *DATED, "dt_pagamento_feito", "ramo", "cd_itcon_pag", "folha",
                *[money(F.coalesce(v, F.lit(0))).alias(v) for v in values])
    )
    return full if per_item else running_totals(full, DATE, ["cd_itcon_pag", "folha"], ITEM_VALUES)


def payment_totals(dates: DataFrame, totals: DataFrame) -> DataFrame:
    """Sums of the item totals per request that has a date; no items means zero."""
    values = [*ITEM_VALUES, "vl_debitos", "vl_creditos"]
    summed = totals.groupBy(REQUEST).agg(*[F.sum(v).alias(v) for v in values])
    return (
        dates.select(REQUEST)
        .distinct()
        .join(summed, REQUEST, "left")
        .select(REQUEST, *[money(F.coalesce(v, F.lit(0))).alias(v) for v in values])
    )


def statement_credits(creddeb: DataFrame) -> DataFrame:
    """All credits and debits of a statement, in the order of its dates and items."""
    return creddeb.orderBy(*DATE, "cd_itcon_pag", "folha", "cd_fatura").select(
        REQUEST, "dt_pagamento_feito", "cd_itcon_pag", "tp_indicador", "tp_debito_credito",
        F.col("ds_observacao").alias("ds_db_cr"), F.col("vl_lancamento").alias("vl_db_cr"),
    )


def own_network(dates: DataFrame) -> DataFrame:
    """Dates of own-network providers: no items follow, the form is a transfer."""
    return dates.filter(F.col("tp_credenciamento") == OWN_NETWORK).withColumn(
        "tp_forma_pagamento", F.lit(OWN_NETWORK_FORM)
    )


def no_payment_errors(req: DataFrame, dates: DataFrame) -> DataFrame:
    """5013 for a request without any date, naming what it asked for."""
    what = F.when(F.col("dt_competencia").isNull(), "DATA DE PAGAMENTO").otherwise("COMPETÊNCIA")
    asked = F.coalesce(F.col("dt_competencia"), F.date_format("dt_dia", "dd/MM/yyyy"))
    return req.join(both_large(dates.select(REQUEST).distinct()), REQUEST, "left_anti").select(
        REQUEST,
        "id",
        F.lit("5013").alias("cd_motivo_glosa"),
        F.concat(F.lit(NO_PAYMENT), what, F.lit(" FORNECIDA: "), joined(asked)).alias("ds_motivo_glosa"),
    )


def payment_statement_rows(req: DataFrame, totals: DataFrame, as_of: date, *ids: str) -> DataFrame:
    """Statement heads; a request without dates keeps empty totals."""
    gross = {
        "vl_total_geral_informado": "vl_informado", "vl_total_geral_processado": "vl_informado",
        "vl_total_geral_liberado": "vl_liberado", "vl_total_geral_glosa": "vl_glosa",
        "vl_total_debitos_dem": "vl_debitos", "vl_total_creditos_dem": "vl_creditos",
        "vl_liberado_dem": "vl_liberado", "vl_info_bruto": "vl_informado", "vl_processado_bruto": "vl_informado",
        "vl_liberado_bruto": "vl_liberado", "vl_glosa_bruto": "vl_glosa",
    }
    return req.join(totals, REQUEST, "left").select(
        *ids, REQUEST, "id", "nr_registro_ans", "ds_operadora", "nr_cnpj_operadora",
        F.lit(as_of.isoformat()).alias("dt_emissao"), "cd_prestador", F.col("nm_prestador").alias("ds_prestador"),
        F.col("nr_cnes").alias("nr_cnes_prestador"), *[F.col(src).alias(out) for out, src in gross.items()],
    )


def payment_item_rows(totals: DataFrame, details: DataFrame, *ids: str) -> DataFrame:
    return totals.join(details, "cd_itcon_pag", "left").select(
        *ids, *ITEM, "tp_forma_pagamento", "cd_banco", F.col("cd_agencia").alias("nr_agencia"), "nr_conta_cheque",
        F.col("vl_informado").alias("vl_total_info_item"), F.col("vl_liberado").alias("vl_total_processado_item"),
        F.col("vl_liberado").alias("vl_total_liberado_item"), F.col("vl_glosa").alias("vl_total_glosa_item"),
        F.col("vl_debitos").alias("vl_total_debitos_item"), F.col("vl_creditos").alias("vl_total_creditos_item"),
        F.col("vl_liberado").alias("vl_liquido_item"),
    )


def item_credit_rows(listed: DataFrame) -> DataFrame:
    """The credits and debits under each item, from the result of ``credits_debits``."""
    return listed.select(
        *ITEM, "tp_indicador", "tp_debito_credito", F.col("ds_observacao").alias("ds_debito_credito"),
        F.col("vl_lancamento").alias("vl_debito_credito"),
    )
