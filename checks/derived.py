"""Domain tables derived from the driver's parquet tables, as portable SQL.

The same text runs in Spark and in the SQL check, so both sides read equal rows.
FIXTURES.md describes the tables; ``fx_config`` is written as one branch per key.
"""

from __future__ import annotations

import re
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from claimspark.schemas import conform
from claimspark.session import shared_dir

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

SQL: dict[str, str] = {
    "fx_li": """
        select l_orderkey as ok, l_linenumber as ln, min(l_partkey) as pk, min(l_suppkey) as sk,
        min(l_quantity) as qty, cast(min(l_extendedprice) as decimal(18,2)) as price, cast(min(l_discount)
        as decimal(4,2)) as disc, min(l_returnflag) as flag, min(l_linestatus) as st, min(l_shipdate) as
        ship from lineitem group by l_orderkey, l_linenumber""",
    "fx_ord": """
        select o.o_orderkey as ok, o.o_custkey as ck, o.o_orderstatus as ost, cast(o.o_totalprice as
        decimal(18,2)) as total, o.o_orderdate as odate, o.o_orderpriority as pri,
        cast(year(o.o_orderdate)*100+month(o.o_orderdate) as bigint) as ym, l.prov from orders o join
        (select ok, min(sk) as prov from fx_li group by ok) l on l.ok = o.o_orderkey""",
    "fx_notice": """
        select distinct ym as cd_ressarcimento_sus, make_date(cast(floor(ym/100) as int), cast(ym%100 as
        int), 1) as dt_oficio, cast(1+ym%2 as bigint) as cd_multi_empresa from fx_ord""",
    "fx_item": """
        select l.ok*10+l.ln as cd_item_ressarciment_sus_anexo, o.ym*10 as cd_ressarcimento_sus_anexo, o.ym
        as cd_ressarcimento_sus, o.ok as nr_atendimento, o.ck*100+o.ck%7 as cd_cco, case when o.ok%10=0 then
        'UPS '||cast(l.sk as varchar(20)) else 'UPS '||o.ost end as nm_ups, o.pri as nm_municipio, o.ost as
        cd_uf, o.odate as dt_inicio, l.ship as dt_fim, l.pk as cd_procedimento, l.price as vl_procedimento,
        o.total as vl_total, case when o.ok%3=0 then null else o.pri end as ds_atendimento, case when
        l.ln%4<>0 then 'S' else 'N' end as sn_confirmar, case when l.st='F' then 'P' else 'E' end as
        tp_procedimento from fx_li l join fx_ord o on o.ok=l.ok""",
    "fx_validation": """
        select (ok*10+ln)*2 as cd_valida_item_ress_sus_anexo, ok*10+ln as cd_item_ressarciment_sus_anexo,
        case flag when 'A' then 'A' when 'N' then 'I' else 'E' end as tp_validacao, case when flag='A' then
        null else 'MSG '||st end as ds_mensagem, ship as dt_validacao from fx_li union all select
        (ok*10+ln)*2+1, ok*10+ln, 'A', null, ship from fx_li where ok%5=0""",
    "fx_reimb": """
        select ok as cd_reembolso, ym as cd_ressarcimento_sus, case ost when 'F' then 'C' when 'O' then 'E'
        else 'N' end as tp_status from fx_ord where ym%100=1""",
    "fx_reimb_item": """
        select l.ok as cd_reembolso, l.pk as cd_procedimento, sum(l.price) as vl_cobrado,
        sum(cast(l.price*(1-l.disc) as decimal(18,2))) as vl_procedimento from fx_li l join fx_reimb r on
        r.cd_reembolso=l.ok group by l.ok, l.pk""",
    "fx_member": """
        select c_custkey+1000000 as cd_matricula, c_custkey as cd_cco, c_custkey%7 as nr_div_cco, c_name as
        nm_segurado, c_mktsegment as cd_mat_alternativa, case when c_custkey%3=0 then null else
        c_custkey-c_custkey%3+1000000 end as cd_matricula_tem, case when c_custkey%5=0 then null else
        c_nationkey end as cd_fornecedor, cast(1+c_custkey%2 as bigint) as cd_multi_empresa from customer
        where c_mktsegment<>'FURNITURE'""",
    "fx_depara": """
        select p_partkey as cd_procedimento_sus, p_partkey+40000000 as cd_procedimento from part where
        p_partkey%10<>0""",
    "fx_staging": """
        select ok*10+ln as cd_item_ress_sus_anexo from fx_li where (ok*10+ln)%13=0""",
    "fx_attach": """
        select cd_ressarcimento_sus*10 as cd_ressarcimento_sus_anexo, cd_ressarcimento_sus,
        'file_'||cast(cd_ressarcimento_sus as varchar(20)) as ds_arquivo from fx_notice""",
    "fx_history": """
        select cd_ressarcimento_sus*10+1 as cd_historico_ressarcimento_sus, cd_ressarcimento_sus, 'OPEN' as
        ds_observacao from fx_notice union all select cd_ressarcimento_sus*10+2, cd_ressarcimento_sus,
        'CHECK' from fx_notice""",
    "fx_doctype": """
        select n_nationkey as cd_tip_doc, n_name as ds_tip_doc, case when n_regionkey=0 then 'N' else 'S'
        end as sn_ativo from nation""",
    "fx_supplier": """
        select s_suppkey as cd_fornecedor, s_name as nm_fornecedor, case when s_acctbal<0 then 'N' else 'S'
        end as sn_ativo, case when s_suppkey%3=0 then null else s_nationkey end as cd_banco, case when
        s_suppkey%3=0 then null else cast(s_suppkey%50 as varchar(20)) end as cd_agencia, case when
        s_suppkey%3=0 then null else cast(s_suppkey*11 as varchar(20)) end as nr_conta from supplier""",
    "fx_bank": """
        select n_nationkey as cd_banco from nation where n_nationkey%5<>0""",
    "fx_provider": """
        select s_suppkey as cd_prestador, 10000000000+s_suppkey*97 as nr_cpf_cgc, cast(s_suppkey+5000 as
        varchar(20)) as cd_interno, case when s_suppkey%20=7 then cast(300000+s_suppkey as varchar(20)) end
        as cd_registro_ans_intermed, s_name as nm_prestador, case when s_acctbal<0 then 'I' else 'A' end as
        tp_situacao, case when s_suppkey%5=0 then 'P' else 'C' end as tp_credenciamento,
        s_suppkey-s_suppkey%2 as cd_prestador_guia_web, cast(1 as bigint) as cd_multi_empresa from supplier""",
    "fx_termination": """
        select s_suppkey as cd_prestador, make_date(2023, cast(1+s_suppkey%12 as int), 1) as
        dt_desligamento, case when s_suppkey%4=0 then make_date(2023,12,1) end as dt_reativacao from
        supplier where s_acctbal<0""",
    "fx_address": """
        select s_suppkey*10 as cd_prestador_endereco, s_suppkey as cd_prestador, 'S' as sn_principal, case
        when s_suppkey%6=0 then null else cast(2000000+s_suppkey as varchar(20)) end as cd_cnes from
        supplier union all select s_suppkey*10+1, s_suppkey, 'N', null from supplier""",
    "fx_address_authoriser": """
        select cd_prestador_endereco, cd_prestador_endereco+7 as cd_autorizador from fx_address""",
    "fx_authoriser": """
        select cd_prestador_endereco+7 as cd_autorizador, 'k'||cast(cd_prestador as varchar(20)) as ds_senha
        from fx_address""",
    "fx_insurer": """
        select cast(r_regionkey+1 as bigint) as cd_multi_empresa, cast(300000+r_regionkey as bigint) as
        nr_ans from region""",
    "fx_company": """
        select cast(r_regionkey+1 as bigint) as cd_multi_empresa, cast(40000000000+r_regionkey as bigint) as
        cd_cgc, r_name as ds_multi_empresa from region""",
    "fx_config": """
        select 'CONTMED_FOLHA_PGTO' as chave, cd_multi_empresa, case when cd_multi_empresa=1 then 'S' else
        'N' end as valor from fx_insurer union all select 'WEBSERVICE_SENHA_MD5' as chave, cd_multi_empresa,
        'N' as valor from fx_insurer union all select 'VERSAO_TISS' as chave, cd_multi_empresa, '3.05.01' as
        valor from fx_insurer union all select 'TISS_LOGIN_UNIMED' as chave, cd_multi_empresa, '900' as valor
        from fx_insurer union all select 'TISS_SENHA_UNIMED' as chave, cd_multi_empresa, 'k900' as valor from
        fx_insurer union all select 'WEBSERVICE_DEMONST_RETORNO' as chave, cd_multi_empresa, case when
        cd_multi_empresa=5 then 'N' else 'S' end as valor from fx_insurer union all select
        'WEBSERVICE_VALIDA_LOGIN_SENHA' as chave, cd_multi_empresa, case when cd_multi_empresa=5 then 'N'
        else 'S' end as valor from fx_insurer""",
    "fx_message": """
        select event_id as id, case event_id%8 when 0 then '9.99.99' when 1 then '2.02.03' when 2 then
        '2.01.03' when 3 then '3.01.00' else '3.05.00' end as cd_versao, case when event_id%11=0 then
        '399999' else 'ANS-300000' end as nr_registro_ans_destino, case when event_id%22=0 then '1' end as
        nr_cnpj_pagador_destino, case when event_id%13=0 then null else cast(user_id%120 as varchar(20)) end
        as cd_prestador_operadora, cast(10000000000+(user_id%120)*97 as varchar(20)) as
        nr_cnpj_prestador_operadora, cast(null as varchar(20)) as nr_cpf_prestador_operadora, case when
        event_id%17=0 then '300007' end as nr_registro_ans_origem, cast(user_id%120 as varchar(20)) as
        ds_login_prestador, case when event_id%3=0 then 'bad' else 'k'||cast(user_id%120 as varchar(20)) end
        as ds_senha_prestador, case when event_id%7=0 then 'MV' else '10.0.0.1' end as nr_ws_ip_remetente,
        cast(cast(ts as date) as varchar(20)) as dt_transacao, '10:20:30' as hr_transacao from events""",
    "fx_request": """
        select event_id+1000000 as cd_tiss_demnstrv_retorno, event_id as cd_pai, case event_id%5 when 0 then
        '1' when 1 then '2' when 2 then '3' when 3 then null else '1' end as tp_demonstrativo, user_id%120
        as cd_prestador_contratado, case when event_id%17=0 then '199913' when event_id%19=0 then null else
        cast((1995+event_id%7)*100+1+event_id%12 as varchar(20)) end as dt_competencia, case when
        event_id%19=0 then make_date(cast(1995+event_id%7 as int), cast(1+event_id%12 as int), 5) end as
        dt_pagamento, cast(ts as date) as dt_solicitacao from events""",
    "fx_req_proto": """
        select r.cd_tiss_demnstrv_retorno as cd_pai, o.ok as nr_protocolo from fx_request r join fx_ord o on
        o.prov=r.cd_prestador_contratado and o.ok%50=r.cd_pai%50 where r.tp_demonstrativo in ('2','3') union
        all select cd_tiss_demnstrv_retorno, 900000000+cd_pai from fx_request where tp_demonstrativo in
        ('2','3') and cd_pai%9=0 union all select r.cd_tiss_demnstrv_retorno, o.ok from fx_request r join
        fx_ord o on o.ok=r.cd_pai where r.tp_demonstrativo in ('2','3') and
        o.prov<>r.cd_prestador_contratado""",
    "fx_protocol": """
        select ok as cd_protocolo_ctamed, prov as cd_prestador, odate as dt_envio_lote, case ost when 'F'
        then 3 when 'O' then 6 else 2 end as cd_status_protocolo, case when ok%37=0 then '5013' end as
        cd_glosa_protocolo, ok%1000 as nr_lote_prestador, prov*1000000+ym as cd_fatura from fx_ord""",
    "fx_lot": """
        select ok+1000000 as cd_lote, case when ok%11=0 then null else ok end as cd_protocolo_ctamed, odate
        as dt_lote, prov*1000000+ym as cd_fatura from fx_ord""",
    "fx_invoice": """
        select distinct prov*1000000+ym as cd_fatura, cast(1 as bigint) as cd_multi_empresa from fx_ord""",
    "fx_denial": """
        select '5013' as cd_glosa, 'DENIED' as ds_glosa""",
    "fx_claim": """
        select l.ok as cd_conta_medica, l.ln as cd_lancamento, l.ok+1000000 as cd_lote, o.prov*1000000+o.ym
        as cd_fatura, o.prov*1000000+o.ym as cd_repasse_prestador, l.ok*10+l.ln%3 as nr_guia, case when
        l.ln%5=0 then null else 'G'||cast(l.ok*10+l.ln%2 as varchar(20)) end as cd_guia_externa, case when
        l.ln%4=0 then l.sk else o.prov end as cd_prestador, o.prov as cd_prestador_principal, o.ck+1000000
        as cd_matricula, case l.flag when 'A' then 'AT' when 'R' then 'AU' else case when l.st='F' then 'NA'
        else 'AT' end end as tp_situacao, 2-l.ln%2 as tp_origem, case when l.disc>0.05 then cast(l.disc*100
        as int) end as cd_motivo, l.pk as cd_procedimento, 'PROC '||cast(l.pk as varchar(20)) as
        ds_procedimento, l.ln%3 as cd_atividade_medica, o.odate as dt_entrada, l.ship as dt_saida, l.ship as
        dt_realizado, l.ok*10+l.ln as id_tiss_item, 'B'||cast(o.ck as varchar(20)) as nm_beneficiario,
        cast(o.ck as varchar(20)) as nr_carteira_beneficiario, cast(l.qty as decimal(18,2)) as qt_cobrado,
        cast(l.qty as decimal(18,2)) as qt_pago, cast(10 as decimal(18,2)) as vl_unit_cobrado, cast(9 as
        decimal(18,2)) as vl_unit_pago, l.price as vl_total_cobrado, cast(l.price*l.disc as decimal(18,2))
        as vl_total_glosado, l.price-cast(l.price*l.disc as decimal(18,2)) as vl_total_pago from fx_li l
        join fx_ord o on o.ok=l.ok""",
    "fx_guide": """
        select distinct nr_guia, cd_matricula, case when nr_guia%9=0 then 'S' else 'N' end as
        sn_atendimento_recem_nato from fx_claim where nr_guia%4<>0""",
    "fx_batch_guide": """
        select ok as cd_protocolo_ctamed, cast(price as varchar(30)) as vl_total_procedimento from fx_li
        where ok%6<>0""",
    "fx_reason": """
        select distinct cd_motivo, 'REASON '||cast(cd_motivo as varchar(20)) as ds_motivo, case when
        cd_motivo%2=0 then cast(1700+cd_motivo as varchar(20)) end as cd_tiss from fx_claim where cd_motivo
        is not null and cd_motivo<>7""",
    "fx_proctable_18": """
        select p_partkey as cd_procedimento from part where p_partkey%4<>0 and p_size%5=0 union all select
        p_partkey from part where p_partkey%10=1""",
    "fx_proctable_19": """
        select p_partkey as cd_procedimento from part where p_partkey%4<>0 and p_size%5=1""",
    "fx_proctable_20": """
        select p_partkey as cd_procedimento from part where p_partkey%4<>0 and p_size%5=2""",
    "fx_proctable_22": """
        select p_partkey as cd_procedimento from part where p_partkey%4<>0 and p_size%5>2""",
    "fx_transfer": """
        select distinct prov*1000000+ym as cd_repasse_prestador, prov*1000000+ym as cd_fatura, prov as
        cd_prestador, prov*10000+cast(floor(ym/100) as bigint) as cd_con_pag, case when prov%5=0 then
        prov*1000000+ym end as cd_pagamento_prestador from fx_ord""",
    "fx_ownpay": """
        select cd_pagamento_prestador, make_date(cast(floor(cd_pagamento_prestador%1000000/100) as int),
        cast(cd_pagamento_prestador%100 as int), 1) as dt_competencia from fx_transfer where
        cd_pagamento_prestador is not null""",
    "fx_payable": """
        select distinct cd_con_pag, cd_prestador as cd_fornecedor, cast(1 as bigint) as cd_multi_empresa
        from fx_transfer""",
    "fx_payable_item": """
        select cd_con_pag*10+1 as cd_itcon_pag, cd_con_pag from fx_payable union all select cd_con_pag*10+2,
        cd_con_pag from fx_payable""",
    "fx_payment": """
        select i.cd_itcon_pag*10+1 as cd_pagcon_pag, i.cd_itcon_pag, make_date(cast(i.cd_con_pag%10000 as
        int), cast(1+p.cd_fornecedor%12 as int), 5) as dt_pagamento, cast(1+p.cd_fornecedor%9 as
        varchar(20)) as tp_pagamento, case when p.cd_fornecedor%3=0 then cast(p.cd_fornecedor%25 as int) end
        as cd_banco_forn, case when p.cd_fornecedor%6=0 then '77' end as cd_agencia_forn, case when
        p.cd_fornecedor%3=1 then '88' end as nr_conta_forn, case when p.cd_fornecedor%4=0 then
        'CH'||cast(i.cd_itcon_pag as varchar(20)) end as cd_cheque from fx_payable_item i join fx_payable p
        on p.cd_con_pag=i.cd_con_pag""",
    "fx_creddeb": """
        select cd_fatura, case when cd_fatura%2=0 then 'C' else 'D' end as tp_lancamento, 'ADJ' as
        ds_observacao, cast(cd_fatura%97 as decimal(18,2)) as vl_lancamento from fx_invoice where
        cd_fatura%3=0""",
    "fx_chart": """
        select p_partkey%5 as cd_plano, case when p_partkey%4=0 then '1.2.1' else '2.'||cast(p_partkey as
        varchar(20)) end as cd_contabil, p_partkey as cd_reduzido, case when p_partkey%8=0 then null else
        p_name end as ds_conta from part""",
    "fx_closed_month": """
        select n_nationkey%5 as cd_plano, cast(case when n_nationkey>=20 then 2 else 1 end as bigint) as
        cd_multi_empresa, make_date(cast(1995+n_nationkey%5 as int), cast(1+(n_nationkey-n_nationkey%5)/5 as int), 1)
        as dt_ano, '0'||cast(cast(2+(n_nationkey-n_nationkey%5)/5 as int) as varchar(20)) as dt_mes from nation""",
    "fx_ledger": """
        select p_partkey as cd_reduzido, '2.'||cast(p_partkey as varchar(20)) as cd_contabil, p_type as
        ds_conta, cast(1 as bigint) as cd_multi_empresa from part where p_partkey%3<>0""",
    "fx_message_mixed": """
        select id, cd_versao, nr_registro_ans_destino, nr_cnpj_pagador_destino, cd_prestador_operadora,
        nr_cnpj_prestador_operadora, nr_cpf_prestador_operadora, nr_registro_ans_origem, ds_login_prestador,
        ds_senha_prestador, nr_ws_ip_remetente, case when cd_versao='2.01.03' then
        substring(dt_transacao,9,2)||'/'||substring(dt_transacao,6,2)||'/'||substring(dt_transacao,1,4) else
        dt_transacao end as dt_transacao, case when cd_versao='2.01.03' then '10:20' else hr_transacao end
        as hr_transacao from fx_message""",
    "fx_account_request": """
        select ok*10+ln as id, case when ln%3=0 then '1.2.1' when ln%3=1 then '2.'||cast(pk as varchar(20))
        end as cd_contabil, case when ln%2=0 then pk end as cd_reduzido, cast(ship as date) as dt_referencia
        from fx_li""",
}


def needed(sql: str, known: dict[str, str]) -> list[str]:
    """Names of ``known`` that ``sql`` needs, directly or through others, in build order."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b[a-z]+_\w+\b", text):
            if name in known and name not in order:
                visit(known[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    return order


_STORED: dict[tuple[str, str], dict[str, tuple[str, StructType]]] = {}
#: One table is made by one thread; the others wait for it.
_LOCK = threading.RLock()
#: Derived tables that are made at the same time.
WRITERS = 4


class Derived:
    """Domain tables by name, stored on first use: ``Derived(spark, dir)["item"]``.

    The jobs work on stored tables, so each derived table is written once per
    application to the shared folder and read from there.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._files = _STORED.setdefault((spark.sparkContext.applicationId, sf_dir), {})

    def view(self, name: str) -> DataFrame:
        """Derived table ``fx_<name>`` as the SQL gives it."""
        self.prepare(name)
        path, schema = self._files[name]
        return self.spark.read.schema(schema).parquet(path)

    def prepare(self, *names: str) -> None:
        """Store the derived tables of these names and all they need, side by side where none needs the other."""
        with _LOCK:
            steps = [s for s in dict.fromkeys(s for n in names for s in (*needed(SQL[n], SQL), n)) if s not in self._files]
            if not steps:
                return
            for base in set(BASE) & {w for s in steps for w in re.findall(r"\b[a-z]\w+\b", SQL[s])}:
                read = self.spark.read.parquet(f"{self.sf_dir}/{base}.parquet")
                # the lines are grouped by their whole key once: dealt by it first, they are sorted once, not on either side
                read = read.repartition("l_orderkey", "l_linenumber") if base == "lineitem" else read
                read.createOrReplaceTempView(base)
            made = {}

            def store(step: str) -> None:
                for earlier in needed(SQL[step], SQL):
                    if earlier in made:
                        made[earlier].result()
                self._files[step] = self._store(step)

            # in build order, so a step only waits for others that have started
            with ThreadPoolExecutor(WRITERS) as pool:
                for step in steps:
                    made[step] = pool.submit(store, step)
            for step in steps:
                made[step].result()

    def _store(self, step: str) -> tuple[str, StructType]:
        for earlier in set(re.findall(r"\b[a-z]\w+\b", SQL[step])) & set(self._files):
            path, schema = self._files[earlier]
            self.spark.read.schema(schema).parquet(path).createOrReplaceTempView(earlier)
        df = self.spark.sql(SQL[step])
        path = f"{shared_dir(self.spark)}/derived/{uuid.uuid4().hex}/{step}"
        df.write.parquet(path)
        return path, df.schema

    def __getitem__(self, name: str) -> DataFrame:
        """Table ``name`` in its explicit schema."""
        return conform(self.view(f"fx_{name}"), "message" if name == "message_mixed" else name)

    def with_tables(self, **changed: DataFrame) -> Overlay:
        """The same tables with some replaced."""
        return Overlay(self, changed)


class Overlay:
    def __init__(self, base: Derived, changed: dict[str, DataFrame]):
        self.base, self.changed = base, changed

    def __getitem__(self, name: str) -> DataFrame:
        return self.changed[name] if name in self.changed else self.base[name]
