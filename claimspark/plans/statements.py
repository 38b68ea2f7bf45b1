"""Job: statement requests -> analysis statements, payment statements and error rows.

``t`` is a mapping of table name to DataFrame, with the names of ``claimspark.schemas``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from datetime import date
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimspark.operators import analysis as a
from claimspark.operators import dispatch as d
from claimspark.operators import payment as p
from claimspark.operators.picks import both_large
from claimspark.plans.headers import validate_headers
from claimspark.schemas import PROCEDURE_TABLES
from claimspark.session import staged
from claimspark.sources.keys import assign_ids

Tables = Mapping[str, DataFrame]
Stage = Callable[[DataFrame], DataFrame]


class Frames(Mapping):
    """Frames by name, each made when it is first read: a grain that nobody asks for stages nothing."""

    def __init__(self, **makers: Callable[[], DataFrame]):
        self._makers, self._made = makers, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def made(self, name: str) -> bool:
        """Whether the frame has been read already."""
        return name in self._made

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def judged_requests(t: Tables, as_of: date, tenant: int, fix_network_login: bool = False) -> DataFrame:
    """Readable requests with their header verdict, route and reply provider."""
    verdicts = validate_headers(
        t["message"], t["insurer"], t["company"], t["provider"], t["termination"], t["address"], t["address_authoriser"],
        t["authoriser"], t["config"], as_of, tenant, fix_network_login,
    )
    read = d.readable_requests(a.requests(t["message"], t["request"])).join(verdicts, "id")
    return d.provider_fallback(d.route(d.service_gate(read, t["config"])))


def _fine(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("g_cabecalho").isNull() & F.col("g_corpo").isNull())


def analysis_frames(req: DataFrame, t: Tables, stage: Stage = staged) -> Frames:
    """What the grains of the analysis statements are made of.

    Frames that several grains start from are materialised by ``stage``: they are read
    often, and a plan that repeats them grows with every use. The lots are materialised too: a small side
    whose size is known spares the claims their shuffle.
    """

    def claims() -> DataFrame:
        # the totals alone need few columns of the claims; where the guides are listed, the claims lie ready
        return f["rows"] if f.made("rows") else a.claims_of(f["lots"], t["claim"])

    f = Frames(
        judged=lambda: stage(a.body_verdict(a.contracted_provider(req, t["provider"], t["address"]))),
        fine=lambda: _fine(f["judged"]),
        protocols=lambda: stage(
            # what a protocol needs of its request, which is repeated for each
            a.protocol_verdict(
                a.requested_protocols(f["fine"].select(a.REQUEST, "cd_prestador", "dt_solicitacao"), t["req_proto"]),
                t["protocol"], t["lot"], t["provider"],
            )
        ),
        lots=lambda: stage(a.shown_lots(f["protocols"], t["lot"], t["invoice"])),
        rows=lambda: stage(a.claims_of(f["lots"], t["claim"])),
        totals=lambda: stage(a.protocol_totals(f["protocols"], claims(), t["denial"])),
        lines=lambda: stage(a.guide_totals(f["rows"], t["guide"], t["member"], t["provider"])),
        procs=lambda: a.procedure_table(
            a.guide_procedures(f["lines"], f["rows"]), {c: t[f"proctable_{c}"] for c in PROCEDURE_TABLES}
        ),
        heads=lambda: a.statement_totals(f["fine"], f["totals"]),
        error=lambda: a.error_rows(f["judged"]),
    )
    return f


def analysis_statement(req: DataFrame, t: Tables, as_of: date, stage: Stage = staged) -> Frames:
    """Analysis statements of the requests routed to them."""
    f = analysis_frames(req, t, stage)

    def guides() -> DataFrame:
        lines = f["lines"]
        return a.guides_of(f["totals"], lines)

    under = Frames(guides=guides, procedures=lambda: a.procedures_of(under["guides"], f["procs"]))
    return Frames(
        statement=lambda: a.statement_rows(f["heads"], as_of),
        protocol=lambda: a.protocol_rows(f["totals"]),
        guide=lambda: a.guide_rows(under["guides"]),
        procedure=lambda: a.procedure_rows(under["procedures"]),
        denial=lambda: a.denial_rows(under["procedures"], t["reason"]),
        error=lambda: f["error"],
    )


def payment_frames(req: DataFrame, t: Tables, stage: Stage = staged) -> Frames:
    """What the grains of the payment statements are made of."""

    def details() -> DataFrame:
        # the payments of the listed items alone are looked at for form, bank, office and account
        listed = both_large(f["items"].select("cd_itcon_pag").distinct())
        paid, payable = (t[n].join(listed, "cd_itcon_pag", "left_semi") for n in ("payment", "payable_item"))
        return p.payment_details(paid, payable, t["payable"], t["supplier"], t["bank"])

    f = Frames(
        judged=lambda: stage(p.payment_verdict(a.contracted_provider(p.parse_period(req), t["provider"], t["address"]))),
        fine=lambda: _fine(f["judged"]),
        dates=lambda: stage(
            p.payment_dates(f["fine"], t["transfer"], t["invoice"], t["payable"], t["payable_item"], t["payment"],
                            t["provider"], t["ownpay"], t["config"])
        ),
        items=lambda: stage(
            p.payment_items(f["dates"], t["transfer"], t["invoice"], t["payable"], t["payable_item"], t["payment"],
                            t["provider"], t["config"])
        ),
        summary=lambda: stage(
            p.transfer_summary(p.transfers_of(f["items"], t["transfer"]), t["claim"], t["lot"], t["protocol"], t["batch_guide"], stage)
        ),
        credits=lambda: stage(
            p.payable_credits(f["items"], t["transfer"], t["protocol"], t["lot"], t["claim"], t["creddeb"], stage)
        ),
        details=details,
        error=lambda: a.error_rows(f["judged"]),
    )
    return f


def payment_statement(req: DataFrame, t: Tables, as_of: date, stage: Stage = staged) -> Frames:
    """Payment statements of the requests routed to them."""
    f = payment_frames(req, t, stage)
    under = Frames(
        totals=lambda: p.item_totals(f["items"], t["transfer"], f["summary"], f["credits"]),
        listed=lambda: p.credits_debits(f["items"], f["credits"]),
    )
    return Frames(
        statement=lambda: p.payment_statement_rows(f["fine"], p.payment_totals(f["dates"], under["totals"]), as_of),
        item=lambda: p.payment_item_rows(under["totals"], f["details"]),
        summary=lambda: p.summary_rows(f["items"], t["transfer"], f["summary"]),
        item_credit=lambda: p.item_credit_rows(under["listed"]),
        statement_credit=lambda: p.statement_credits(under["listed"]),
        error=lambda: f["error"].unionByName(p.no_payment_errors(f["fine"], f["dates"])),
    )


def other_errors(req: DataFrame) -> DataFrame:
    """Error rows of the requests that ask for neither statement."""
    return req.filter(F.col("ds_destino") == "ERRO").select(
        a.REQUEST, "id", F.col("g_cabecalho.cd_glosa").alias("cd_motivo_glosa"),
        F.col("g_cabecalho.ds_glosa").alias("ds_motivo_glosa"),
    )


def statements(t: Tables, as_of: date, tenant: int = 1, stage: Stage = staged,
               fix_network_login: bool = False, first_log: int = 1) -> Frames:
    """Every request ends in exactly one of: analysis, payment, error row.

    ``first_log``: number of the first log row, so that a later run goes on where the last one ended.

    Keys: ``reply``, ``analysis_*``, ``payment_*``, ``error``, ``log``.
    """
    req = stage(judged_requests(t, as_of, tenant, fix_network_login))
    failed = d.failed_requests(a.requests(t["message"], t["request"]))
    numbered = assign_ids(failed, ["id"], first_log, "cd_tiss_mensagem_log")
    analysis = analysis_statement(req.filter(F.col("ds_destino") == "ANALISE"), t, as_of, stage)
    payment = payment_statement(req.filter(F.col("ds_destino") == "PAGAMENTO"), t, as_of, stage)

    def errors() -> DataFrame:
        of_kind = analysis["error"].unionByName(payment["error"]).unionByName(other_errors(req))
        return of_kind.unionByName(d.error_replies(numbered))

    grains = {
        f"{kind}_{name}": partial(made.__getitem__, name)
        for kind, made in (("analysis", analysis), ("payment", payment)) for name in made if name != "error"
    }
    return Frames(
        reply=lambda: d.reply_header(req).unionByName(d.failed_replies(numbered, t["config"], tenant)),
        **grains, error=errors, log=lambda: d.error_log(numbered, as_of),
    )
