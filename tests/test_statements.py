import io
import re
from contextlib import redirect_stdout
from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from claimspark.operators import analysis as a
from claimspark.functions import lenient_time
from claimspark.operators import dealt
from claimspark.operators import dispatch as d
from claimspark.operators import header as h
from claimspark.operators import payment as p
from claimspark.operators.ledger import account_name
from claimspark.operators.running import running_totals
from claimspark.plans import statements as st
from claimspark.plans.headers import resolved_headers, validate_headers
from claimspark.sources import tables as s
from claimspark.sources.keys import assign_ids
from tests.conftest import values

AS_OF = date(2024, 1, 31)


def message(i, **kw):
    base = dict(id=i, cd_versao="3.05.00", nr_registro_ans_destino="ANS-300", cd_prestador_operadora="7",
                nr_ws_ip_remetente="10.0.0.1", ds_login_prestador="p7", ds_senha_prestador="k7",
                dt_transacao="2024-01-05", hr_transacao="10:20:30")
    return {**base, **kw}


@pytest.fixture(scope="module")
def registry(table):
    return dict(
        insurers=table("insurer", dict(cd_multi_empresa=1, nr_ans=300), dict(cd_multi_empresa=2, nr_ans=301)),
        companies=table("company", dict(cd_multi_empresa=1, cd_cgc=44, ds_multi_empresa="OP"), dict(cd_multi_empresa=3, cd_cgc=45)),
        providers=table(
            "provider", dict(cd_prestador=7, nr_cpf_cgc=111, tp_situacao="A", cd_multi_empresa=1),
            dict(cd_prestador=8, cd_interno="9", tp_situacao="I", cd_multi_empresa=1),
            dict(cd_prestador=9, tp_situacao="A", cd_multi_empresa=1), dict(cd_prestador=10, tp_situacao="I", cd_multi_empresa=1),
        ),
        terminations=table("termination", dict(cd_prestador=10, dt_desligamento=date(2023, 1, 1)),
                           dict(cd_prestador=10, dt_desligamento=date(2024, 1, 1), dt_reativacao=date(2024, 1, 2))),
    )


@pytest.fixture(scope="module")
def secrets(table):
    return dict(
        addresses=table("address", dict(cd_prestador_endereco=70, cd_prestador=7)),
        links=table("address_authoriser", *(dict(cd_prestador_endereco=70, cd_autorizador=i) for i in (1, 2, 4))),
        authorisers=table("authoriser", *(dict(cd_autorizador=i, ds_senha=x) for i, x in ((1, "k7"), (2, "x"), (3, "no")))),
        cfg=table("config", dict(chave="WEBSERVICE_VALIDA_LOGIN_SENHA", cd_multi_empresa=1, valor="S"),
                  dict(chave="TISS_LOGIN_UNIMED", cd_multi_empresa=1, valor="900"),
                  dict(chave="TISS_SENHA_UNIMED", cd_multi_empresa=1, valor="k900")),
    )


def test_first_failing_rule_wins(table, registry, secrets):
    msgs = table(
        "message", message(1), message(2, cd_versao="9"), message(3, hr_transacao="xx", cd_versao="9"),
        message(4, nr_registro_ans_destino="5"), message(5, nr_registro_ans_destino="5", nr_cnpj_pagador_destino="1"),
        message(6, cd_prestador_operadora="99"), message(7, cd_prestador_operadora="009"), message(8, cd_prestador_operadora="10"),
        message(9, ds_senha_prestador="no"), message(10, ds_senha_prestador="no", nr_ws_ip_remetente="MV"),
        message(11, cd_versao="2.01.03"), message(12, cd_versao="2.01.03", dt_transacao="05/01/2024", hr_transacao="10:20"),
        message(13, cd_versao=None), message(14, ds_login_prestador="900", ds_senha_prestador="k900"),
        message(15, dt_transacao=None, hr_transacao=None), message(16, nr_registro_ans_destino="x", nr_cnpj_pagador_destino="44"),
        message(17, nr_registro_ans_destino="301"), message(18, nr_registro_ans_destino="x", nr_cnpj_pagador_destino="45"),
    )
    got = {m.id: (m.cd_glosa, m.cd_prestador_cabecalho) for m in validate_headers(msgs, **registry, **secrets, as_of=AS_OF).collect()}
    assert got == {
        1: (None, 7), 2: ("5013", 7), 3: ("5013", None), 4: ("5004", 7), 5: ("5004", 7), 6: ("1203", None), 7: ("1203", 9),
        8: ("1203", 10), 9: ("5005", 7), 10: (None, 7), 11: ("5013", None), 12: (None, 7), 13: (None, 7), 14: ("5005", 7),
        15: (None, 7), 16: (None, 7), 17: ("5004", 7), 18: ("5004", 7),
    }
    fixed = validate_headers(msgs, **registry, **secrets, as_of=AS_OF, fix_network_login=True)
    assert fixed.filter("id = 14").first().cd_glosa is None
    assert "ds_senha" not in " ".join(fixed.columns)


def test_hashed_secret_and_earlier_rule(table, registry, secrets):
    hashed = secrets["cfg"].unionByName(table("config", dict(chave="WEBSERVICE_SENHA_MD5", cd_multi_empresa=1, valor="S")))
    msgs = table("message", message(1), message(2), message(3, ds_login_prestador="7", ds_senha_prestador="x"))
    real = msgs.withColumn("ds_senha_prestador", F.when(F.col("id") == 1, F.md5(F.lit("k7"))).otherwise(F.col("ds_senha_prestador")))
    rows = resolved_headers(real, **registry, cfg=hashed, as_of=AS_OF, tenant=1)
    got = h.match_credentials(rows, registry["providers"], secrets["addresses"], secrets["links"], secrets["authorisers"], hashed)
    assert values(got, "id", "sn_senha_prestador") == [(1, "S"), (2, "N"), (3, "N")]
    plain = resolved_headers(msgs, **registry, cfg=secrets["cfg"], as_of=AS_OF, tenant=1)
    new, old = (h.match_credentials(plain, registry["providers"], secrets["addresses"], secrets["links"], secrets["authorisers"],
                                    secrets["cfg"], clean_login=c) for c in (True, False))
    assert values(new, "id", "sn_senha_prestador") == [(1, "S"), (2, "S"), (3, "S")]
    assert values(old, "id", "sn_senha_prestador") == [(1, "N"), (2, "N"), (3, "S")]


# Date texts, what they say in the order year first, and why they say nothing.
TIMES = [
    ("2024-01-05 10:20:30", "2024-01-05 10:20:30"), ("2024-1-5 1:2:3", "2024-01-05 01:02:03"), ("2024-01-05", "2024-01-05 00:00:00"),
    ("2024-01-05 ", "2024-01-05 00:00:00"), ("2024/01/05 10.20", "2024-01-05 10:20:00"), ("20240105 102030", "2024-01-05 10:20:30"),
    ("20240105102030", "2024-01-05 10:20:30"), ("2024-01-05  10", "2024-01-05 10:00:00"), ("24-1-5", "0024-01-05 00:00:00"),
    (" 2024 - 2 - 29 ", "2024-02-29 00:00:00"), ("2024-01-05 23:59:59", "2024-01-05 23:59:59"),
    ("2024-13-05", "MES INVALIDO"), ("2024-00-05", "MES INVALIDO"), ("0-1-1", "ANO INVALIDO"), ("2024-01-32", "DIA INVALIDO"),
    ("2024-02-30 10:00", "DIA NAO EXISTE NO MES"), ("2023-2-29", "DIA NAO EXISTE NO MES"), ("2024-01-05 24:00", "HORA INVALIDA"),
    ("2024-01-05 10:60", "MINUTO INVALIDO"), ("2024-01-05 10:20:61", "SEGUNDO INVALIDO"), ("2024-01-05 10:20:30 1", "TEXTO LONGO DEMAIS"),
    ("2024-01-05 10:20:303", "TEXTO LONGO DEMAIS"), ("2024-01-05 xx", "TEXTO LONGO DEMAIS"), ("ontem", "CARACTER NAO NUMERICO"),
    ("", "TEXTO CURTO DEMAIS"), ("2024-01", "TEXTO CURTO DEMAIS"), ("05/01/2024 10:20", "HORA INVALIDA"), (None, None),
]


def test_lenient_dates(spark):
    both = F.coalesce(F.date_format("x.ts", "yyyy-MM-dd HH:mm:ss"), "x.cause").alias("y")
    got = spark.createDataFrame([t[:1] for t in TIMES], "t string").withColumn("x", lenient_time(F.col("t"), h.TIME)).select("t", both)
    assert [tuple(r) for r in got.collect()] == TIMES
    old = [("05/01/2024 10:20", "2024-01-05 10:20:00"), ("5.1.2024", "2024-01-05 00:00:00"), ("05/01/2024 10:20:30", "TEXTO LONGO DEMAIS"), ("2024-01-05", "MES INVALIDO")]
    got = spark.createDataFrame([t[:1] for t in old], "t string").withColumn("x", lenient_time(F.col("t"), h.OLD_TIME)).select("t", both)
    assert [tuple(r) for r in got.collect()] == old


def test_date_pattern_once_a_row(spark):
    """The date's pattern is read once per form and row: repeated by every condition, its code is too large to be compiled."""
    sent = F.lit("2024-01-31 10:20:30").alias("t")
    df = spark.range(1).select(sent).select(lenient_time(F.col("t"), h.TIME)["ts"].alias("ts"), F.col("t")).where("ts is not null")
    plan = df._jdf.queryExecution().analyzed().toString().lower()
    assert plan.count("regexp_extract(") + plan.count("regexp_replace(") + plan.count("rlike(") <= 6
    marks = [("# 2024-01-31", None, "TEXTO CURTO DEMAIS"), ("2024-01-31 10:20:30,#,", None, "TEXTO LONGO DEMAIS"), ("2024,01,31 10", "2024-01-31 10:00:00", None)]
    got = spark.createDataFrame([m[:1] for m in marks], "t string").select("t", lenient_time(F.col("t"), h.TIME).alias("x"))
    assert sorted((r[0], str(r[1]) if r[1] else None, r[2]) for r in got.select("t", "x.ts", "x.cause").collect()) == sorted(marks)


def test_a_failed_request_names_its_cause_and_the_others_go_on(spark):
    ddl = "cd_tiss_demnstrv_retorno long, id long, dt_transacao string, hr_transacao string"
    req = spark.createDataFrame([(1, 1, "2024-1-5", None), (2, 2, "2024-13-05", "10:00"), (3, 3, None, None), (4, 4, "2024-01-05", "25:00:00")], ddl)
    failed = d.failed_requests(req)
    assert values(failed, "id", "ds_causa") == [(2, "MES INVALIDO"), (4, "HORA INVALIDA")]
    assert values(d.readable_requests(req), "id") == [(1,), (3,)]
    log = d.error_log(failed.withColumn("cd_tiss_mensagem_log", F.col("id")), AS_OF)
    assert values(log, "cd_tiss_mensagem", "ds_log") == [(2, f"{d.LOGGED}: MES INVALIDO"), (4, f"{d.LOGGED}: HORA INVALIDA")]


def claims(spark, *rows):
    base = dict(nr_protocolo=1, cd_prestador_pedido=7, cd_prestador=7, cd_prestador_principal=7, tp_situacao="AT", cd_guia_externa=None,
                nr_guia=None, vl_total_pago=None)
    full = [{**base, **x} for x in rows]
    ddl = ("nr_protocolo long, cd_prestador_pedido long, cd_prestador long, cd_prestador_principal long, tp_situacao string, "
           "cd_guia_externa string, nr_guia long, vl_total_pago decimal(18,2)")
    return spark.createDataFrame([tuple(x[c.split()[0]] for c in ddl.split(", ")) for x in full], ddl)


def test_paid_by_either_guide_number_counts_a_line_once(spark):
    rows = claims(spark, dict(cd_guia_externa="E", nr_guia=1, vl_total_pago=D(1)), dict(cd_guia_externa="E", nr_guia=2, vl_total_pago=D(10)),
                  dict(cd_guia_externa="F", nr_guia=1, vl_total_pago=D(100)), dict(nr_guia=3, vl_total_pago=D(1000)),
                  dict(cd_guia_externa="G", nr_guia=4), dict(cd_guia_externa="E", nr_guia=1, cd_prestador=8, vl_total_pago=D(5)))
    got = a.guide_paid(rows.drop("cd_prestador_pedido").withColumn("cd_prestador", F.lit(7).cast("long")), rows)
    assert values(got, "cd_guia_externa", "nr_guia", "vl_liberado") == [
        ("E", 1, 111.0), ("E", 2, 11.0), ("F", 1, 101.0), ("G", 4, None), (None, 3, 1000.0)]


def hot_launches(spark):
    """One external number on most guides; three launches a guide."""
    ddl = ("nr_protocolo long, cd_prestador_pedido long, cd_prestador long, cd_prestador_principal long, tp_situacao string, "
           "cd_guia_externa string, nr_guia long, cd_lancamento long, vl_total_cobrado decimal(18,2), vl_total_pago decimal(18,2)")
    data = [(1, 7, 7, 7, "AT", "HOT" if g % 5 else f"E{g}", g if g % 7 else None, launch, D(g), D(launch)) for g in range(60) for launch in range(3)]
    rows = spark.createDataFrame(data, ddl)
    rest = {"dt_realizado": "timestamp_ntz", "cd_tabela": "string", "cd_procedimento": "bigint", "ds_procedimento": "string", "cd_motivo": "bigint",
            "cd_atividade_medica": "bigint", "vl_unit_pago": "decimal(18,2)", "vl_total_glosado": "decimal(18,2)", "qt_pago": "decimal(18,2)"}
    return rows.withColumns({c: F.lit(None).cast(t) for c, t in rest.items()})


def test_hot_guide_number_is_dealt_with_the_same_result(spark):
    rows = hot_launches(spark)
    keys = rows.select("nr_protocolo", "cd_prestador", "cd_guia_externa", "nr_guia")
    plain, cut = (sorted(map(repr, a.guide_procedures(keys, rows, share).collect())) for share in (1 << 20, 5))
    assert plain == cut and len(plain) > 40 * 40


def test_no_lot_of_a_hot_key_is_large(spark):
    data = [("hot" if i % 3 else f"k{i}", i) for i in range(3000)]
    left, right = spark.createDataFrame(data, "k string, x long"), spark.createDataFrame(data[:600], "k string, y long")
    hot = dealt._hot(left, ["k"], 100, True).unionByName(dealt._hot(right, ["k"], 100, False)).groupBy("k").agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    assert [tuple(r) for r in hot.collect()] == [("hot", 20, 4)]
    for df, own, other, copies in ((left, "_a", "_b", 4), (right, "_b", "_a", 20)):
        sizes = [r["count"] for r in dealt._dealt(df, hot, ["k"], own, other).where("k = 'hot'").groupBy("_lot_a", "_lot_b").count().collect()]
        assert len(sizes) == 80 and max(sizes) <= 150 and sum(sizes) == copies * df.where("k = 'hot'").count()
    joined = dealt.dealt_join(left, right, ["k"], 100)
    assert joined.count() == 2000 * 400 + 200 == left.join(right, "k").count() and joined.distinct().count() == joined.count()


def test_missing_value_empties_the_statement_total(spark):
    req = spark.createDataFrame([(1,), (2,), (3,)], f"{a.REQUEST} long")
    cols = ["vl_informado_protocolo", "vl_processado_protocolo", "vl_protocolo", "vl_glosa_protocolo"]
    totals = spark.createDataFrame([(1, D(1), D(1), D(1), D(0)), (1, D(2), D(2), None, D(0)), (2, D(3), D(3), D(3), D(0))],
                                   f"{a.REQUEST} long, " + ", ".join(f"{c} decimal(18,2)" for c in cols))
    got = a.statement_totals(req, totals)
    assert values(got, a.REQUEST, "vl_informado_geral", "vl_liberado_geral") == [(1, 3.0, None), (2, 3.0, 3.0), (3, 0.0, 0.0)]


def test_running_totals_equal_a_plain_loop(spark):
    data = [(g, i * 7 % 1000, D(i)) for g, n in (("hot", 400), ("cold", 3)) for i in range(n)]
    df = spark.createDataFrame(data, "g string, i long, v decimal(18,2)")
    want = []
    for g in ("hot", "cold"):
        total = D(0)
        for row in sorted(x for x in data if x[0] == g):
            total += row[2]
            want.append((g, row[1], float(total)))
    for width in (1, 16, 1 << 16):
        assert values(running_totals(df, ["g"], ["i"], ["v"], width), "g", "i", "v") == sorted(want, key=repr)


def test_one_value_over_all_sources(spark):
    one = spark.createDataFrame([(1, "A"), (2, "A"), (3, "A"), (3, "A"), (4, "A"), (4, "B"), (5, None)], "k long, v string")
    two = spark.createDataFrame([(2, "A"), (6, "C")], "k long, v string")
    assert values(p.single_or_null([one, two], "k", "v"), "k", "v") == [(1, "A"), (2, None), (3, "A"), (4, None), (6, "C")]


def test_supplier_bank_must_be_listed(table):
    items = table("payable_item", *[dict(cd_itcon_pag=i, cd_con_pag=i) for i in (1, 2, 3)])
    payables = table("payable", *[dict(cd_con_pag=i, cd_fornecedor=i) for i in (1, 2, 3)])
    suppliers = table("supplier", *[dict(cd_fornecedor=i, cd_banco=b) for i, b in ((1, 10), (2, 20), (3, 20))])
    pays = table("payment", dict(cd_pagcon_pag=1, cd_itcon_pag=1, cd_banco_forn=30), dict(cd_pagcon_pag=2, cd_itcon_pag=3, cd_banco_forn=30))
    got = p.payment_bank(pays, p.supplier_of_item(items, payables, suppliers), table("bank", dict(cd_banco=10)))
    # a bank from either side is NULL; supplier banks that are not listed do not count
    assert values(got, "cd_itcon_pag", "cd_banco") == [(1, None), (3, 30)]


def test_cheque_replaces_account(table, spark):
    pays = table("payment", dict(cd_pagcon_pag=1, cd_itcon_pag=1, cd_cheque="c"), dict(cd_pagcon_pag=2, cd_itcon_pag=2, cd_cheque="c"),
                 dict(cd_pagcon_pag=3, cd_itcon_pag=2, cd_cheque="d"), dict(cd_pagcon_pag=4, cd_itcon_pag=3))
    items = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x")], "cd_itcon_pag long, nr_conta string")
    assert values(p.cheque_override(items, pays), "cd_itcon_pag", "nr_conta_cheque") == [(1, "c"), (2, None), (3, "x")]


def test_bad_period_beats_bad_provider(table):
    rows = p.parse_period(table("request", dict(cd_tiss_demnstrv_retorno=1, dt_competencia="199913"),
                                dict(cd_tiss_demnstrv_retorno=2, dt_competencia="199912"))).withColumn("nr_prestadores", F.lit(0))
    got = p.payment_verdict(rows).select(a.REQUEST, "nr_periodo", F.col("g_corpo.cd_glosa").alias("g"))
    assert values(got, a.REQUEST, "nr_periodo", "g") == [(1, None, "5013"), (2, "121999", "1203")]


def test_account_found_without_name_is_not_looked_up_again(table):
    chart = table("chart", dict(cd_plano=1, cd_contabil="1.2.1", cd_reduzido=5), dict(cd_plano=2, cd_contabil="1.2.1", cd_reduzido=5, ds_conta="OTHER"))
    # the second chart is closed for another tenant, and in another year
    months = table("closed_month", *[dict(cd_plano=c, cd_multi_empresa=m, dt_ano=date(y, 6, 1), dt_mes="03") for c, m, y in
                                     ((1, 1, 2023), (1, 1, 2023), (2, 2, 2023), (2, 1, 2022))])
    now = table("ledger", dict(cd_reduzido=5, cd_contabil="9", ds_conta="NOW", cd_multi_empresa=1))
    ask = table("account_request", dict(id=1, cd_reduzido=5, dt_referencia=date(2023, 3, 9)),
                dict(id=2, cd_reduzido=5, dt_referencia=date(2023, 4, 9)), dict(id=3, cd_reduzido=6, dt_referencia=date(2023, 4, 9)))
    assert values(account_name(ask, chart, months, now, 1), "id", "ds_conta") == [(1, "NAO ENCONTRADO"), (2, "NOW"), (3, "NAO ENCONTRADO")]


def test_ids_are_dense_and_ordered(spark):
    df = spark.range(1000).withColumn("k", (F.col("id") * 37) % 1000).drop("id").repartition(7)
    assert values(assign_ids(df, ["k"], 10, "n").filter("n <> k + 10"), "n") == []


def test_unreadable_import_lines_are_kept_aside(spark, tmp_path, table):
    path = str(tmp_path / "f")
    s.export_items(table("item", dict(cd_item_ressarciment_sus_anexo=1, nm_ups="A;B", vl_procedimento=D("1.50"), dt_inicio=datetime(2020, 1, 2))), path)
    with open(f"{path}/part-extra.csv", "w") as f:
        f.write("header\nnot a number;;;\n")
    got = s.import_items(spark, path, notice_id=4)
    assert values(got.filter(f"{s.BAD_LINE} is null"), s.ITEM, "nm_ups", "vl_procedimento", "cd_ressarcimento_sus") == [(1, "A;B", 1.5, 4)]
    assert got.count() == 2


def test_messages_are_dealt_before_they_are_read(table):
    """A file of few row groups is read by few tasks; the costly reading of its messages is not left to them."""
    sent = table("message", {"id": 1, "cd_versao": "3.05.00", "dt_transacao": "2024-01-31", "hr_transacao": "10:20:30"})
    plan = h.message_fields(sent.coalesce(1), AS_OF)._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.find("transform(") < plan.find("RepartitionByExpression")


def test_times_written_in_full_are_judged_like_all_others(spark):
    texts = {
        "2024-02-29 10:20:30": None, "2023-02-29 10:20:30": "DIA NAO EXISTE NO MES", "0000-01-01 10:20:30": "ANO INVALIDO",
        "2024-13-01 10:20:30": "MES INVALIDO", "2024-01-01 24:00:00": "HORA INVALIDA", "2024-01-01 10:60:00": "MINUTO INVALIDO",
        "2024-01-01 10:20:60": "SEGUNDO INVALIDO", "2024-01-01 10:20:30\n": None, "2024-01-01 10:20:301": "TEXTO LONGO DEMAIS",
    }
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", lenient_time(F.col("t"), h.TIME).alias("x"))
    rows = {r.t: r.x for r in got.collect()}
    assert {t: x["cause"] for t, x in rows.items()} == texts
    assert {t: str(x["ts"]) for t, x in rows.items() if x["ts"]} == {t: t.strip() for t, c in texts.items() if c is None}


def test_header_steps_are_small_enough_to_be_compiled(spark, table, registry, secrets, tmp_path):
    """The JVM interprets a method of more than 8000 bytes, for every message, however many there are."""
    def stored(name, df):
        df.write.parquet(str(tmp_path / name))
        return spark.read.schema(df.schema).parquet(str(tmp_path / name))

    known = {n: stored(n, df) for n, df in (registry | secrets).items()}
    judged = validate_headers(stored("message", table("message", message(1))), **known, as_of=AS_OF)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with redirect_stdout(io.StringIO()) as shown:
            judged.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", shown.getvalue())]
    assert sizes and max(sizes) < 8000


def test_protocol_grain_keeps_no_claims(table):
    """The totals read the few columns they need; the request's own columns are not repeated for each protocol."""
    kept = []
    names = ("provider", "address", "req_proto", "protocol", "lot", "invoice", "claim", "denial", "guide", "member")
    t = {n: table(n) for n in names}
    asked = a.requests(table("message"), table("request"))
    req = asked.withColumn("cd_multi_empresa", F.lit(1).cast("bigint")).withColumn(
        "g_cabecalho", F.lit(None).cast("struct<cd_glosa: string, ds_glosa: string>")
    )

    def stage(df):
        kept.append(df.columns)
        return df

    made = st.analysis_statement(req, t, AS_OF, stage)
    assert made["protocol"].columns and not [c for c in kept if "cd_conta_medica" in c]
    assert not [c for c in kept if "nr_protocolo" in c and "nr_documento" in c]
    # the lots, whose size decides how the claims are joined, are kept
    assert {"cd_lote", "nr_protocolo", "cd_prestador_pedido", "cd_fatura_lote"} in map(set, kept)
    # the guides list the claims, so then they lie ready, once
    kept.clear()
    assert st.analysis_statement(req, t, AS_OF, stage)["guide"].columns
    assert len([c for c in kept if "cd_conta_medica" in c and "qt_pago" in c]) == 1


def test_payment_sides_are_kept_narrow_with_the_same_result(spark, table):
    """What the next large table is joined to is kept first."""
    items = spark.createDataFrame([(1, "S"), (2, "S"), (3, "N")], "cd_con_pag long, folha string")
    transfers = table("transfer", *[dict(cd_repasse_prestador=i, cd_fatura=i * 10, cd_con_pag=i) for i in (1, 2, 3, 4)])
    protocols = table("protocol", *[dict(cd_protocolo_ctamed=i * 100, cd_fatura=i * 10, nr_lote_prestador=i) for i in (1, 3, 4)])
    lots = table("lot", *[dict(cd_lote=i, cd_protocolo_ctamed=i * 100 if i != 2 else None, cd_fatura=i * 10) for i in (1, 2, 3, 4)])
    claims = table("claim", *[
        dict(cd_lote=i, cd_repasse_prestador=i, vl_total_pago=D(i), vl_total_glosado=D(1)) for i in (1, 1, 2, 3, 4)
    ])
    batch = table("batch_guide", *[dict(cd_protocolo_ctamed=i * 100, vl_total_procedimento=f"{i},50") for i in (1, 1, 3, 4)])
    entries = table("creddeb", *[dict(cd_fatura=i * 10, tp_lancamento="C", vl_lancamento=D(i)) for i in (1, 2, 3, 4)])
    kept = []

    def stage(df):
        kept.append(df.columns)
        return df.localCheckpoint()

    wanted = p.transfers_of(items, transfers)
    plain, staged = (p.transfer_summary(wanted, claims, lots, protocols, batch, *more) for more in ((), (stage,)))
    cols = ["cd_repasse_prestador", "folha", "nr_protocolo", "nr_lote", "vl_informado", "vl_liberado", "vl_glosa"]
    assert values(staged, *cols) == values(plain, *cols) == [
        (1, "S", 100, 1, 3.0, 2.0, 2.0), (2, "S", 2, 2, 2.0, 2.0, 1.0), (3, "N", 300, 3, 3.5, 3.0, 1.0)
    ]
    assert len(kept) == 5
    plain, staged = (p.payable_credits(items, transfers, protocols, lots, claims, entries, *more) for more in ((), (stage,)))
    cols = ["cd_con_pag", "cd_fatura", "tp_indicador", "vl_lancamento"]
    assert values(staged, *cols) == values(plain, *cols) == [(1, 10, 1, 1.0), (3, 30, 1, 3.0)]
    assert len(kept) == 8


def test_sides_that_grow_together_are_not_broadcast(spark, table, secrets, registry, tmp_path):
    """By the bytes of its file either side may look small; its rows would meet in the driver."""
    def stored(name, df):
        df.write.parquet(str(tmp_path / name))
        return spark.read.schema(df.schema).parquet(str(tmp_path / name))

    rows = dict(message=message(1), request=dict(cd_pai=1), req_proto=dict(cd_pai=1), payment=dict(cd_itcon_pag=1),
                payable_item=dict(cd_itcon_pag=1), payable=dict(cd_con_pag=1), supplier=dict(cd_fornecedor=1))
    t = {n: stored(n, table(n, row)) for n, row in rows.items()}
    known = {n: stored(n, df) for n, df in (secrets | {"providers": registry["providers"]}).items()}
    asked = stored("asked", spark.range(3).selectExpr(f"id {a.REQUEST}", "2L cd_prestador", "date'2024-01-05' dt_solicitacao"))
    period = asked.selectExpr("*", "1L id", "'202401' dt_competencia", "dt_solicitacao dt_dia")
    logins = t["message"].selectExpr("*", "1L cd_multi_empresa", "'p7' ds_login", "'k7' ds_senha_enviada")
    joins = {
        "requests": (a.requests(t["message"], t["request"]), 1),
        "protocols": (a.requested_protocols(asked, t["req_proto"]), 1),
        "payments": (p.paid_on(t["payable_item"], t["payment"]), 1),
        "suppliers": (p.supplier_of_item(t["payable_item"], t["payable"], t["supplier"]), 2),
        "unpaid": (p.no_payment_errors(period, asked), 1),
        "authorisers": (h.match_credentials(logins, **known), 3),  # the configuration is broadcast
    }
    for name, (df, n) in joins.items():
        plan = df._jdf.queryExecution().sparkPlan().toString()
        assert plan.count("SortMergeJoin") >= n, name
        assert name == "authorisers" or "BroadcastHashJoin" not in plan, name
