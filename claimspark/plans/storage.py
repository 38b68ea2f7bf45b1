"""Job: statement requests -> stored replies, statements, errors and log, each row with its id and its parent's.

The statements are a tree: reply, statement, and below it protocol, guide, procedure and denial, or item, summary and
credits. A grain is numbered when the rows of the one above have their ids: each row carries its parent's id, the rows
are ordered by it, and their place in that order gives their own. So equal rows under different parents keep apart, and
no natural key has to lead back. Each grain of a batch takes one block of the durable sequence.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.operators import analysis as a
from claimspark.operators import dispatch as d
from claimspark.operators import payment as p
from claimspark.operators.picks import both_large
from claimspark.plans.statements import Frames, analysis_frames, judged_requests, other_errors, payment_frames
from claimspark.schemas import conform
from claimspark.session import Run
from claimspark.sources.keys import assign_ids
from claimspark.sources.sequences import Sequence
from claimspark.sources.tables import append

Tables = Mapping[str, DataFrame]

# Names of the sequences: fixed values.
MESSAGES, LOGS = "seq_tiss_mensagem", "seq_tiss_mensagem_log"
#: Tables that are written at the same time.
WRITERS = 4
#: The tables that a batch of statements is stored in.
STORED = [
    "reply", "analysis_statement", "analysis_protocol", "analysis_guide", "analysis_procedure", "analysis_denial",
    "payment_statement", "payment_item", "payment_summary", "payment_item_credit", "payment_statement_credit", "error", "log",
]


class Numbers:
    """Ids of one batch, from the sequences stored beside the tables."""

    def __init__(self, run: Run, base: str, batch: str):
        self.run, self.batch = run, batch
        self.sequences = {name: Sequence(run.spark, base, name) for name in (MESSAGES, LOGS)}

    def block(self, grain: str, count: int, sequence: str = MESSAGES) -> int:
        return self.sequences[sequence].lease(count, f"{self.batch}/{grain}")

    def give(self, rows: DataFrame, order: list[str], grain: str, id_col: str, sequence: str = MESSAGES) -> DataFrame:
        """Rows numbered in the order of ``order``, which starts with the parent's id."""
        return assign_ids(rows, order, lambda n: self.block(grain, n, sequence), id_col, self.run.keep)


def numbered_requests(asked: DataFrame, numbers: Numbers) -> DataFrame:
    """(request, id_resposta, id_demonstrativo): the reply of each request, and the statement or error under it.

    Not broadcast where it is joined: numbers in a row, which files hold in two bytes.
    """
    placed = assign_ids(asked.select(a.REQUEST), [a.REQUEST], 0, "_place", numbers.run.keep)
    count = placed.count()
    first = numbers.block("reply", 2 * count) if count else 0
    reply = F.lit(first) + 2 * F.col("_place")
    return both_large(placed.select(a.REQUEST, reply.alias("id_resposta"), (reply + 1).alias("id_demonstrativo")))


def analysis_tree(f: Frames, t: Tables, tops: DataFrame, as_of: date, numbers: Numbers) -> dict[str, DataFrame]:
    lines = f["lines"]
    heads = f["heads"].join(tops, a.REQUEST)
    totals = f["totals"].join(tops, a.REQUEST)
    protocols = numbers.give(totals, ["id_demonstrativo", "nr_protocolo"], "analysis_protocol", "id_protocolo")
    guides = numbers.give(
        a.guides_of(protocols, lines, "id_protocolo"), ["id_protocolo", *a.GUIDE_LINE], "analysis_guide", "id_guia"
    )
    order = ["id_guia", "cd_lancamento", "dt_realizado", "cd_tabela", "cd_procedimento", "cd_motivo"]
    procs = numbers.give(a.procedures_of(guides, f["procs"], "id_guia"), order, "analysis_procedure", "id_procedimento")
    denials = numbers.give(
        a.denial_rows(procs, t["reason"], "id_procedimento"), ["id_procedimento"], "analysis_denial", "id_glosa"
    )
    return {
        "analysis_statement": _under(a.statement_rows(heads, as_of, "id_demonstrativo", "id_resposta"), "id_demonstrativo", "id_resposta"),
        "analysis_protocol": a.protocol_rows(protocols, "id_protocolo", "id_demonstrativo").withColumns(
            {"id": F.col("id_protocolo"), "cd_tiss_dem_ana": F.col("id_demonstrativo")}
        ),
        "analysis_guide": _under(a.guide_rows(guides, "id_guia", "id_protocolo"), "id_guia", "id_protocolo"),
        "analysis_procedure": _under(a.procedure_rows(procs, "id_procedimento", "id_guia"), "id_procedimento", "id_guia").withColumn(
            "dt_realizacao", F.col("dt_execucao")
        ),
        "analysis_denial": _under(denials, "id_glosa", "id_procedimento"),
        "error": f["error"],
    }


def payment_tree(f: Frames, t: Tables, tops: DataFrame, as_of: date, numbers: Numbers) -> dict[str, DataFrame]:
    order = ["id_demonstrativo", "dt_pagamento_feito", "ramo", "cd_itcon_pag", "folha"]
    items = numbers.give(f["items"].join(tops, a.REQUEST), order, "payment_item", "id_item")
    totals = numbers.run.keep(p.item_totals(items, t["transfer"], f["summary"], f["credits"], ids=("id_item", "id_demonstrativo")))
    summary = numbers.give(
        p.summary_rows(items, t["transfer"], f["summary"], "id_item"),
        ["id_item", "cd_repasse_prestador", "dt_protocolo", "nr_protocolo", "nr_lote"], "payment_summary", "id_resumo",
    )
    listed = numbers.give(
        p.credits_debits(items, f["credits"], "id_item", "id_demonstrativo"),
        ["id_item", "cd_fatura", "tp_indicador", "ds_observacao", "vl_lancamento"], "payment_item_credit", "id_lancamento",
    )
    # a statement lists the entries of all its items in their order, which their numbers tell
    whole = numbers.give(
        listed.select("id_demonstrativo", "id_lancamento", "tp_indicador", "tp_debito_credito", "ds_observacao", "vl_lancamento"),
        ["id_demonstrativo", "id_lancamento"], "payment_statement_credit", "id_geral",
    )
    heads = p.payment_statement_rows(
        f["fine"].join(tops, a.REQUEST), p.payment_totals(f["dates"], totals), as_of, "id_demonstrativo", "id_resposta"
    )
    return {
        "payment_statement": _under(heads, "id_demonstrativo", "id_resposta"),
        "payment_item": p.payment_item_rows(totals, f["details"], "id_item", "id_demonstrativo").withColumns(
            {"cd_tiss_dem_pgt_item": F.col("id_item"), "id_pai": F.col("id_demonstrativo"), "dt_pagamento": F.col("dt_pagamento_feito")}
        ),
        "payment_summary": summary.withColumns({"cd_tiss_dem_pgt_item_resumo": F.col("id_resumo"), "id_pai": F.col("id_item")}),
        "payment_item_credit": listed.withColumns(
            {
                "cd_tiss_dem_pgt_item_deb_cre": F.col("id_lancamento"), "cd_tiss_dem_pgt_item": F.col("id_item"),
                "ds_debito_credito": F.col("ds_observacao"), "vl_debito_credito": F.col("vl_lancamento"),
            }
        ),
        "payment_statement_credit": whole.withColumns(
            {
                "cd_tiss_dem_pgt_deb_cre": F.col("id_geral"), "id_pai": F.col("id_demonstrativo"),
                "ds_db_cr": F.col("ds_observacao"), "vl_db_cr": F.col("vl_lancamento"),
            }
        ),
        "error": f["error"].unionByName(p.no_payment_errors(f["fine"], f["dates"])),
    }


def _under(rows: DataFrame, own: str, parent: str) -> DataFrame:
    """``id`` and ``id_pai`` as the tables name them; a statement's number is its id."""
    return rows.withColumns({"id": F.col(own), "id_pai": F.col(parent), "nr_demonstrativo": F.col(own)})


def stored_statements(t: Tables, as_of: date, tenant: int, numbers: Numbers, fix_network_login: bool = False) -> dict[str, DataFrame]:
    """All tables of ``STORED``, from the frames of one run; read them before the run closes."""
    keep = numbers.run.keep
    asked = a.requests(t["message"], t["request"])
    # many small steps one behind another leave most of a cluster idle: what does not depend on each other goes side by side
    with ThreadPoolExecutor(WRITERS) as pool:
        tops = pool.submit(numbered_requests, asked, numbers)
        req = pool.submit(lambda: keep(judged_requests(t, as_of, tenant, fix_network_login)))
        failed = pool.submit(numbers.give, d.failed_requests(asked), ["id"], "log", "cd_tiss_mensagem_log", LOGS)
        tops, req, failed = tops.result(), req.result(), failed.result()
        analysis = analysis_frames(req.filter(F.col("ds_destino") == "ANALISE"), t, keep)
        payment = payment_frames(req.filter(F.col("ds_destino") == "PAGAMENTO"), t, keep)
        for frames in (analysis, payment):  # one behind the other: each sends the providers by three keys through the driver
            frames["judged"]
        analysis = pool.submit(analysis_tree, analysis, t, tops, as_of, numbers)
        payment = pool.submit(payment_tree, payment, t, tops, as_of, numbers)
        analysis, payment = analysis.result(), payment.result()
    errors = analysis.pop("error").unionByName(payment.pop("error")).unionByName(other_errors(req))
    errors = errors.unionByName(d.error_replies(failed)).join(tops, a.REQUEST)
    replies = d.reply_header(req).unionByName(d.failed_replies(failed, t["config"], tenant)).join(tops, a.REQUEST)
    out = {
        "reply": replies.withColumn("id", F.col("id_resposta")),
        **analysis,
        **payment,
        "error": errors.withColumns({"cd_tiss_dem_retorno_erro": F.col("id_demonstrativo"), "cd_tiss_mensagem": F.col("id_resposta")}),
        "log": d.error_log(failed, as_of),
    }
    return {name: conform(out[name], name) for name in STORED}


def write_statements(t: Tables, base: str, batch: str, as_of: date, tenant: int = 1, fix_network_login: bool = False) -> None:
    """Store one batch of requests below ``base``: a folder per table of ``STORED``, the sequences beside them.

    A batch that is run again replaces its own rows. With the same input it gets the same blocks of ids; a grain that has
    more or fewer rows than before gets a new one. Nothing of the run's own frames stays behind.
    """
    spark = t["message"].sparkSession
    with Run(spark) as run:
        out = stored_statements(t, as_of, tenant, Numbers(run, base, batch), fix_network_login)
        with ThreadPoolExecutor(WRITERS) as pool:  # the tables do not depend on each other any more
            list(pool.map(lambda name: append(out[name], f"{base}/{name}", batch), STORED))
