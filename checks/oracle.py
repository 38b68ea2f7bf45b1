"""SQL the results are checked against, as named steps put together into one query.

The steps state the rules directly (OR conditions, correlated matches, plain windows);
they do not follow the way the Spark operators are built.
"""

from __future__ import annotations

from checks.derived import SQL, needed

AS_OF = "date '2024-01-31'"
TENANT = "1"

STEPS: dict[str, str] = {}


def step(name: str, sql: str) -> None:
    STEPS[name] = sql


def cast_as(col: str, kind: str) -> str:
    """Plain types only in the output: text, bigint, double."""
    forms = {
        "i": "cast({0} as bigint)",
        "b": "cast({0} as bigint)",
        "m": "cast(cast({0} as decimal(18,2)) as double)",
        "s": "cast({0} as varchar)",
        "d": "strftime({0}, '%Y-%m-%d')",
        "t": "strftime({0}, '%Y-%m-%d %H:%M:%S')",
    }
    return forms[kind].format(col) + f" as {col}"


def query(source: str, spec: str) -> str:
    """``select`` of the columns of ``spec`` (name:kind ...) with all steps it needs."""
    cols = ", ".join(cast_as(*c.split(":")) for c in spec.split())
    body = f"select {cols} from {source}"
    known = {**SQL, **STEPS}
    steps = needed(body, known)
    named = ",\n".join(f"{n} as materialized ({known[n].strip()})" for n in steps)
    return f"with {named}\n{body}" if named else body


# --- charge notices ---------------------------------------------------------------

CCO = "cast(cd_cco as varchar)"
CODE = f"case when length({CCO}) > 2 then lpad(left({CCO}, length({CCO}) - 2), 10, '0') end"
CHECK = f"lpad(right({CCO}, 2), 2, '0')"

step("o_item", f"select *, {CODE} as cd_cco_base, {CHECK} as nr_div_cco from fx_item")
step("o_all", """
select i.*, v.tp_validacao, v.ds_mensagem, n.dt_oficio
from o_item i
join fx_notice n on n.cd_ressarcimento_sus = i.cd_ressarcimento_sus
join fx_validation v on v.cd_item_ressarciment_sus_anexo = i.cd_item_ressarciment_sus_anexo""")
step("o_kept", "select * from o_all where sn_confirmar = 'S'")

for suffix, rows in (("", "o_kept"), ("_any", "o_all")):
    step(f"o_summary{suffix}", f"""
select cd_ressarcimento_sus, cd_cco, nr_atendimento, nm_municipio, cd_uf, nm_ups, cd_cco_base, nr_div_cco,
  max(dt_inicio) as dt_ultimo_inicio, min(dt_inicio) as dt_atendimento, max(dt_fim) as dt_alta,
  count(*) as nr_qtd, sum(vl_procedimento) as vl_qtd
from {rows} i
where tp_validacao <> 'E'
  and not exists (select 1 from fx_reimb m where m.cd_ressarcimento_sus = i.cd_ressarcimento_sus)
group by all""")
    step(f"o_notes{suffix}", f"""
select distinct cd_ressarcimento_sus, nr_atendimento, cd_cco_base, nr_div_cco, ds_atendimento
from {rows} where ds_atendimento is not null""")
    step(f"o_lines{suffix}", f"""
select i.cd_ressarcimento_sus, i.nr_atendimento, i.cd_cco_base, i.nr_div_cco, i.cd_cco,
  d.cd_procedimento as cd_procedimento_mapeado, i.dt_oficio,
  sum(case when i.tp_validacao = 'I' then 0 else i.vl_procedimento end) as vl_qtd,
  sum(i.vl_procedimento) as vl_qtd_original, count(*) as nr_qtd
from {rows} i left join fx_depara d on d.cd_procedimento_sus = i.cd_procedimento
group by all""")
    step(f"o_critiques{suffix}", f"""
select distinct i.cd_ressarcimento_sus, i.nr_atendimento, i.cd_cco_base, i.nr_div_cco, i.cd_cco, i.ds_mensagem,
  i.tp_validacao, d.cd_procedimento as cd_procedimento_mapeado
from {rows} i left join fx_depara d on d.cd_procedimento_sus = i.cd_procedimento
where i.ds_mensagem is not null""")

step("o_split", "select distinct cd_cco, cd_cco_base, nr_div_cco from o_item")
step("o_guard", """
select n.* from fx_notice n
where not exists (select 1 from fx_reimb m where m.cd_ressarcimento_sus = n.cd_ressarcimento_sus)""")
step("o_text", """
select cd_ressarcimento_sus, nr_atendimento, cd_cco_base, nr_div_cco,
  nullif(trim(string_agg(coalesce(cast(cd_procedimento_mapeado as varchar), '') || ' : ' || ds_mensagem || chr(10), ''
    order by cd_cco, tp_validacao nulls last, ds_mensagem, cd_procedimento_mapeado nulls last), ' '), '') as ds_criticas
from o_critiques group by all""")
step("o_member", """
select * from (
  select lpad(cast(u.cd_cco as varchar), 10, '0') as cd_cco_base, lpad(cast(u.nr_div_cco as varchar), 2, '0') as nr_div_cco,
    u.cd_matricula, u.cd_multi_empresa, coalesce(h.cd_fornecedor, u.cd_fornecedor) as cd_fornecedor,
    row_number() over (partition by lpad(cast(u.cd_cco as varchar), 10, '0'), lpad(cast(u.nr_div_cco as varchar), 2, '0')
      order by u.cd_matricula) as rn
  from fx_member u left join fx_member h on h.cd_matricula = u.cd_matricula_tem)
where rn = 1""")
step("o_resolved", """
select m.* from o_member m
where exists (select 1 from o_summary s where s.cd_cco_base = m.cd_cco_base and s.nr_div_cco = m.nr_div_cco)""")
step("o_mapped", """
select i.cd_item_ressarciment_sus_anexo, i.cd_procedimento, d.cd_procedimento as cd_procedimento_mapeado
from fx_item i left join fx_depara d on d.cd_procedimento_sus = i.cd_procedimento""")
step("o_head", f"""
select row_number() over (order by s.cd_ressarcimento_sus nulls first, s.cd_cco nulls first, s.nr_atendimento nulls first,
    s.nm_municipio nulls first, s.cd_uf nulls first, s.nm_ups nulls first) as cd_reembolso,
  s.*, m.cd_matricula, {TENANT} as cd_multi_empresa, m.cd_fornecedor, x.ds_criticas as ds_consideracoes_internas,
  'R' as tp_reembolso, s.nr_atendimento as cd_controle_interno, 'N' as sn_quitar_mensalidade,
  left(s.nm_ups, 50) as ds_prestador, s.vl_qtd as vl_total_original, {AS_OF} as dt_inclusao,
  'U1' as cd_usuario_inclusao, {AS_OF} as dt_ultima_atualizacao, 'BATCH' as cd_usuario_ultima_atualizacao,
  {AS_OF} + 30 as dt_vencimento, 'F' as tp_pessoa, 'E' as tp_status, s.nm_municipio as ds_municipio,
  'N' as sn_notificado, 'N' as sn_recusado, '1' as tp_status_reembolso
from o_summary s
join o_member m on m.cd_cco_base = s.cd_cco_base and m.nr_div_cco = s.nr_div_cco
left join o_text x on x.cd_ressarcimento_sus = s.cd_ressarcimento_sus and x.nr_atendimento = s.nr_atendimento
  and x.cd_cco_base = s.cd_cco_base and x.nr_div_cco = s.nr_div_cco""")
step("o_reimb_item", """
select h.cd_reembolso, h.cd_ressarcimento_sus, h.nr_atendimento, h.nm_municipio, h.cd_uf, h.nm_ups, l.cd_cco,
  l.cd_procedimento_mapeado, coalesce(l.cd_procedimento_mapeado, -1) as cd_procedimento, l.vl_qtd as vl_procedimento,
  l.nr_qtd as qt_cobrado, l.vl_qtd_original as vl_cobrado, 'U1' as cd_usuario_inclusao, l.dt_oficio as dt_usuario_inclusao
from o_head h join o_lines l on l.cd_ressarcimento_sus = h.cd_ressarcimento_sus and l.nr_atendimento = h.nr_atendimento
  and l.cd_cco_base = h.cd_cco_base and l.nr_div_cco = h.nr_div_cco""")
step("o_denial", f"""
select cd_reembolso, cd_ressarcimento_sus, nr_atendimento, nm_municipio, cd_uf, nm_ups, cd_cco,
  cd_procedimento_mapeado as cd_procedimento, 9630 as cd_motivo, cd_usuario_inclusao, {AS_OF} as dt_usuario_inclusao
from o_reimb_item where coalesce(vl_procedimento, 0) < coalesce(vl_cobrado, 0)""")
step("o_linked", """
select i.cd_item_ressarciment_sus_anexo, i.sn_confirmar,
  (select max(h.cd_reembolso) from o_head h where h.cd_ressarcimento_sus = i.cd_ressarcimento_sus
     and h.nr_atendimento = i.nr_atendimento and h.cd_cco_base = i.cd_cco_base and h.nr_div_cco = i.nr_div_cco) as cd_reembolso
from o_item i""")
step("o_confirmed", """
select i.cd_item_ressarciment_sus_anexo, i.vl_procedimento,
  case when exists (select 1 from fx_staging s where s.cd_item_ress_sus_anexo = i.cd_item_ressarciment_sus_anexo)
    then 'N' else i.sn_confirmar end as sn_confirmar
from fx_item i""")

# --- sources and sinks ------------------------------------------------------------

step("o_scan", "select o_orderkey, o_custkey, o_orderdate, o_totalprice from orders")
step("o_config", """
select m.cd_matricula, m.cd_multi_empresa,
  coalesce((select min(c.valor) from fx_config c where c.chave = 'CONTMED_FOLHA_PGTO'
    and c.cd_multi_empresa = m.cd_multi_empresa), 'N') as ds_folha,
  coalesce((select min(c.valor) from fx_config c where c.chave = 'CHAVE_AUSENTE'
    and c.cd_multi_empresa = m.cd_multi_empresa), 'N') as ds_ausente
from fx_member m""")
step("o_consumed", """
select 'LIDO' as ds_tabela, cd_item_ress_sus_anexo from fx_staging""")
step("o_impugned", """
select v.cd_valida_item_ress_sus_anexo, i.cd_item_ressarciment_sus_anexo, i.cd_ressarcimento_sus, i.nr_atendimento,
  i.cd_cco, i.cd_procedimento, i.vl_procedimento, v.ds_mensagem
from fx_item i join fx_validation v on v.cd_item_ressarciment_sus_anexo = i.cd_item_ressarciment_sus_anexo
where v.tp_validacao = 'I'""")

# --- notice screens ---------------------------------------------------------------

step("o_listing", """
select distinct i.cd_item_ressarciment_sus_anexo, i.cd_ressarcimento_sus_anexo, i.nm_ups, i.nm_municipio, i.cd_uf,
  i.nr_atendimento, i.dt_inicio, i.dt_fim, u.cd_matricula, u.cd_mat_alternativa, u.nm_segurado,
  coalesce(i.cd_cco_base, '') || i.nr_div_cco as cd_cco, i.cd_procedimento, i.vl_procedimento, i.ds_atendimento,
  i.vl_total, i.cd_ressarcimento_sus, v.tp_validacao, i.sn_confirmar, i.tp_procedimento
from o_item i
left join fx_member u on lpad(cast(u.cd_cco as varchar), 10, '0') = i.cd_cco_base
  and lpad(cast(u.nr_div_cco as varchar), 2, '0') = i.nr_div_cco
left join fx_validation v on v.cd_item_ressarciment_sus_anexo = i.cd_item_ressarciment_sus_anexo""")
step("o_validations", """
select v.*, case v.tp_validacao when 'A' then 'AUTORIZADO' when 'I' then 'IMPUGNADO' when 'E' then 'ERRO' end as ds_validacao
from fx_validation v
where v.cd_item_ressarciment_sus_anexo in (
  select i.cd_item_ressarciment_sus_anexo from fx_item i join fx_notice n on n.cd_ressarcimento_sus = i.cd_ressarcimento_sus)""")
step("o_notices", f"select * from fx_notice where cd_multi_empresa = {TENANT}")
step("o_attach", "select a.* from fx_attach a join fx_notice n on n.cd_ressarcimento_sus = a.cd_ressarcimento_sus")
step("o_history", "select h.* from fx_history h join fx_notice n on n.cd_ressarcimento_sus = h.cd_ressarcimento_sus")
step("o_doctype", "select cd_tip_doc, ds_tip_doc from fx_doctype where sn_ativo = 'S'")
step("o_supplier", "select cd_fornecedor, nm_fornecedor from fx_supplier where sn_ativo = 'S'")
_parts = []
for _tag, _hit in (("", "true"), ("_e", "r.tp_status = 'E'"), ("_c", "r.tp_status = 'C'"), ("_n", "r.tp_status = 'N'")):
    _parts.append(f"""count(distinct r.cd_reembolso) filter (where {_hit}) as nr_reembolsos{_tag},
  coalesce(sum(i.vl_cobrado) filter (where {_hit}), 0) as vl_cobrado{_tag},
  coalesce(sum(i.vl_procedimento) filter (where {_hit}), 0) as vl_pagar{_tag},
  coalesce(sum(i.vl_cobrado - i.vl_procedimento) filter (where {_hit}), 0) as vl_glosado{_tag}""")
step("o_status", f"""
select r.cd_ressarcimento_sus, {", ".join(_parts)}
from fx_reimb r left join fx_reimb_item i on i.cd_reembolso = r.cd_reembolso group by r.cd_ressarcimento_sus""")
step("o_attendance_total", """
select cd_ressarcimento_sus, sum(vl_procedimento) as vl_atendimentos from fx_item group by cd_ressarcimento_sus""")
step("o_severity", """
select cd_item_ressarciment_sus_anexo, g as nr_gravidade,
  case g when 3 then 'VERMELHO' when 2 then 'AMARELO' when 1 then 'VERDE' end as ds_cor
from (select cd_item_ressarciment_sus_anexo,
  max(case tp_validacao when 'E' then 3 when 'I' then 2 when 'A' then 1 end) as g
  from fx_validation group by cd_item_ressarciment_sus_anexo)""")

# --- message headers --------------------------------------------------------------


def only_digits(c: str) -> str:
    return f"nullif(regexp_replace({c}, '[^0-9]+', '', 'g'), '')"


VERSIONS = """('3.05.01', '3.05.00', '3.04.01', '3.04.00', '3.03.03', '3.03.02', '3.03.01', '3.03.00', '3.02.02', '3.02.01',
  '3.02.00', '3.01.00', '2.02.03', '2.02.02', '2.02.01', '2.01.03')"""
T_DATE = "ERRO AO PROCESSAR DADOS DA MENSAGEM TISS. ERRO; "
T_VERSION = (
    "VERSAO TISS INVALIDA. APENAS AS VERSOES 3.04.01, 3.04.00, 3.03.03, 3.03.02, 3.03.01, 3.03.00, 3.02.02, "
    "3.02.01, 3.02.00, 3.01.00 , 2.02.03, 2.02.02, 2.02.01 e 02.01.03 S?O ACEITAS"
)


def verdict(name: str, condition: str, code: str, text: str) -> str:
    return f"case when {condition} then '{code}' end as {name}_cd, case when {condition} then {text} end as {name}_ds"


def header_steps(p: str, messages: str) -> None:
    """The header rules over one message table; ``p`` prefixes the step names."""
    when = "coalesce(dt_transacao, '') || ' ' || coalesce(substring(hr_transacao, 1, 8), '')"
    step(f"{p}read", f"""
select *, case when dt_transacao is null and hr_transacao is null then cast({AS_OF} as timestamp)
  when cd_versao <= '2.01.03' then try_strptime({when}, '%d/%m/%Y %H:%M')
  else try_strptime({when}, '%Y-%m-%d %H:%M:%S') end as dt_mensagem
from {messages}""")
    fields = {
        "cd_versao_lida": "cd_versao",
        "nr_registro_destino": only_digits("nr_registro_ans_destino"),
        "nr_cnpj_destino": only_digits("nr_cnpj_pagador_destino"),
        "cd_prestador_enviado": only_digits("cd_prestador_operadora"),
        "nr_documento_prestador": only_digits(
            "coalesce(nullif(nr_cnpj_prestador_operadora, ''), nullif(nr_cpf_prestador_operadora, ''))"
        ),
        "nr_registro_origem": only_digits("nr_registro_ans_origem"),
        "ds_login": "ds_login_prestador",
        "ds_senha_enviada": "ds_senha_prestador",
        "nr_ip_remetente": "nr_ws_ip_remetente",
    }
    masked = ", ".join(f"case when dt_mensagem is not null then {e} end as {c}" for c, e in fields.items())
    step(f"{p}msg", f"""
select id, dt_mensagem, {masked}, {verdict("g_data", "dt_mensagem is null", "5013", f"'{T_DATE}'")} from {p}read""")
    step(f"{p}version", f"""
select *, {verdict("g_versao", f"cd_versao_lida not in {VERSIONS}", "5013", f"'{T_VERSION}'")} from {p}msg""")
    step(f"{p}plan", f"""
select m.*, x.cd_multi_empresa, x.nr_ans as nr_registro_ans, lpad(cast(x.cd_cgc as varchar), 14, '0') as nr_cnpj_operadora,
  x.ds_multi_empresa as ds_operadora, x.id is not null as plano_achado,
  {verdict("g_operadora", "x.id is null and m.g_data_cd is null and m.g_versao_cd is null", "5004",
           "case when m.nr_cnpj_destino is not null then 'DESTINATARIO INVALIDO - CNPJ DA OPERADORA N?O IDENTIFICADO'"
           " else 'DESTINATARIO INVALIDO - NUMERO DE REGISTRO DA OPERADORA NA ANS INVALIDO' end")},
  {verdict("g_empresa", "x.id is not null and x.cd_multi_empresa is null", "5013",
           "'CODIGO MULTI_EMPRESA NAO CONFIGURADO. ENTRE EM CONTATO COM A OPERADORA'")}
from {p}version m
left join (select m.id, l.cd_multi_empresa, l.nr_ans, k.cd_cgc, k.ds_multi_empresa,
    row_number() over (partition by m.id order by l.cd_multi_empresa) as rn
  from {p}version m, fx_insurer l, fx_company k
  where m.g_data_cd is null and m.g_versao_cd is null and l.cd_multi_empresa = k.cd_multi_empresa
    and (l.nr_ans = try_cast(m.nr_registro_destino as bigint) or k.cd_cgc = try_cast(m.nr_cnpj_destino as bigint))) x on x.id = m.id and x.rn = 1""")
    code = "cast(try_cast(m.cd_prestador_enviado as hugeint) as varchar)"
    step(f"{p}provider", f"""
select m.*, least(coalesce(x.n, 0), 2) as nr_prestadores, x.cd_prestador as cd_prestador_cabecalho,
  (select q.tp_situacao from fx_provider q where q.cd_prestador = x.cd_prestador) as tp_situacao
from {p}plan m
left join (select m.id, count(distinct r.cd_prestador) as n, max(r.cd_prestador) as cd_prestador
  from {p}plan m join fx_provider r on r.cd_multi_empresa = coalesce(m.cd_multi_empresa, {TENANT}) and (
    lpad(cast(r.nr_cpf_cgc as varchar), 14, '0') = coalesce({code}, lpad(m.nr_documento_prestador, 14, '0'))
    or r.cd_interno = {code} or cast(r.cd_prestador as varchar) = {code}
    or r.cd_registro_ans_intermed = m.nr_registro_origem)
  group by m.id) x on x.id = m.id""")
    checked = "cd_versao_lida >= '3.01.00'"
    step(f"{p}gone", f"""
select m.*, t.dt_desligamento,
  {verdict("g_prestador", f"{checked} and nr_prestadores <> 1", "1203",
           "case when nr_prestadores = 0 then 'CODIGO PRESTADOR INVALIDO OU INATIVO [NO ORIGEM]' else"
           " 'CODIGO PRESTADOR [NO ORIGEM] COM MAIS DE UM REGISTRO. ENTRE EM CONTATO COM A OPERADORA' end")},
  {verdict("g_desligamento", f"{checked} and nr_prestadores = 1 and tp_situacao <> 'A' and t.dt_desligamento + 180 < {AS_OF}",
           "1203", "'PRESTADOR INATIVO. ENTRE EM CONTATO COM A OPERADORA [NO ORIGEM]'")}
from {p}provider m
left join (select cd_prestador, max(dt_desligamento) as dt_desligamento from fx_termination
  where dt_reativacao is null group by cd_prestador) t on t.cd_prestador = m.cd_prestador_cabecalho""")

    def cfg(key: str, tenant: str) -> str:
        return f"(select min(c.valor) from fx_config c where c.chave = '{key}' and c.cd_multi_empresa = {tenant})"

    own = f"coalesce(m.cd_multi_empresa, {TENANT})"
    secret = f"case when {cfg('WEBSERVICE_SENHA_MD5', own)} = 'S' then md5(a.ds_senha) else a.ds_senha end"
    for clean, name in ((only_digits("m.ds_login"), "cred"), ("m.ds_login", "cred_old")):
        step(f"{p}{name}", f"""
select m.*, coalesce(m.{checked} and m.nr_ip_remetente <> 'MV'
    and coalesce({cfg('WEBSERVICE_VALIDA_LOGIN_SENHA', own)}, 'N') = 'S', false) as sn_exige_senha,
  case when exists (select 1 from fx_address e join fx_address_authoriser b on b.cd_prestador_endereco = e.cd_prestador_endereco
      join fx_authoriser a on a.cd_autorizador = b.cd_autorizador
      join fx_provider q on q.cd_prestador = e.cd_prestador
    where e.cd_prestador = try_cast({clean} as bigint) and {secret} = m.ds_senha_enviada) then 'S' else 'N' end
    as sn_senha_prestador,
  'N' as sn_senha_rede,
  case when m.ds_login = {cfg('TISS_LOGIN_UNIMED', own)} and {cfg('TISS_SENHA_UNIMED', own)} =
    case when {cfg('WEBSERVICE_SENHA_MD5', own)} = 'S' then md5(m.ds_senha_enviada) else m.ds_senha_enviada end
    then 'S' else 'N' end as sn_senha_rede_fix
from {p}gone m""")
    order = ["g_data", "g_versao", "g_operadora", "g_empresa", "g_prestador", "g_desligamento"]
    bad = "sn_exige_senha and sn_senha_prestador = 'N' and sn_senha_rede = 'N'"
    login = "'REMETENTE N?O IDENTIFICADO - LOGIN OU SENHA do PRESTADOR INVALIDOS'"
    step(f"{p}verdict", f"""
select id, cd_prestador_cabecalho, nr_registro_ans, cd_multi_empresa, nr_cnpj_operadora, ds_operadora,
  coalesce({", ".join(g + "_cd" for g in order)}, case when {bad} then '5005' end) as cd_glosa,
  coalesce({", ".join(g + "_ds" for g in order)}, case when {bad} then {login} end) as ds_glosa
from {p}cred""")


header_steps("h_", "fx_message")

# --- statement requests -----------------------------------------------------------


def request_steps(p: str, messages: str) -> None:
    when = "coalesce(m.dt_transacao, '') || ' ' || coalesce(substring(m.hr_transacao, 1, 8), '')"
    step(f"{p}request", f"""
select r.*, r.cd_pai as id, m.cd_versao, m.nr_registro_ans_destino, m.cd_prestador_operadora,
  m.nr_cnpj_prestador_operadora, m.nr_cpf_prestador_operadora,
  (m.dt_transacao is not null or m.hr_transacao is not null)
    and try_strptime({when}, '%Y-%m-%d %H:%M:%S') is null as ilegivel
from (select *, row_number() over (partition by cd_pai order by cd_tiss_demnstrv_retorno) as rn from fx_request) r
join {messages} m on m.id = r.cd_pai where r.rn = 1""")


request_steps("o_", "fx_message")
step("o_asked", f"select *, {TENANT} as cd_multi_empresa, null as g_cd, null as g_ds, "
     "null as nr_registro_ans, null as ds_operadora, null as nr_cnpj_operadora from o_request")
step("j_judged", """
select r.*, v.cd_prestador_cabecalho, v.nr_registro_ans, v.cd_multi_empresa, v.nr_cnpj_operadora, v.ds_operadora,
  v.cd_glosa, v.ds_glosa, c.valor
from o_request r join h_verdict v on v.id = r.id
left join fx_config c on c.chave = 'WEBSERVICE_DEMONST_RETORNO' and c.cd_multi_empresa = v.cd_multi_empresa
where not r.ilegivel""")
_off = "upper(coalesce(valor, 'N')) = 'N'"
step("j_gated", f"""
select *, case when tp_demonstrativo = '1' then 'PAGAMENTO' when tp_demonstrativo in ('2', '3') then 'ANALISE' else 'ERRO' end
    as ds_destino,
  case when cd_glosa is not null then cd_glosa when {_off} or tp_demonstrativo is null then '5013' end as g_cd,
  case when cd_glosa is not null then ds_glosa
    when {_off} then 'WEB SERVICE DEMONSTRATIVO RETORNO NÃO ESTÁ ATIVO - ENTRE EM CONTATO COM A OPERADORA'
    when tp_demonstrativo is null then 'NÃO FOI INFORMADO UM TIPO DE DEMONSTRATIVO NA SOLICITAÇÃO' end as g_ds,
  coalesce(cast(cd_prestador_cabecalho as varchar), cd_prestador_operadora) as cd_prestador_resposta,
  case when cd_prestador_cabecalho is null then nr_cnpj_prestador_operadora end as nr_cnpj_resposta,
  case when cd_prestador_cabecalho is null then nr_cpf_prestador_operadora end as nr_cpf_resposta
from j_judged""")
step("j_asked", "select * from j_gated")
step("j_reply", """
select cd_tiss_demnstrv_retorno, id as cd_tiss_mensagem_origem,
  case when ds_destino = 'ANALISE' then 'DEMONSTRATIVO_ANALISE_CONTA' else 'DEMONSTRATIVO_PAGAMENTO' end as tp_transacao,
  case when ds_destino = 'ANALISE' then 'demonstrativoAnaliseConta' else 'demonstrativoPagamento' end as nm_xml,
  coalesce(cast(nr_registro_ans as varchar), nr_registro_ans_destino, '999999') as nr_registro_ans, nr_cnpj_operadora,
  cd_versao, cd_prestador_resposta as cd_prestador, nr_cnpj_resposta as nr_cnpj_prestador,
  nr_cpf_resposta as nr_cpf_prestador, g_cd as cd_glosa, g_ds as ds_glosa
from j_gated""")


def statement_steps(p: str) -> None:
    """Analysis and payment rules over the requests of step ``<p>asked``."""
    step(f"{p}contracted", f"""
select q.*, least(coalesce(x.n, 0), 2) as nr_prestadores, v.cd_prestador, v.nm_prestador, v.tp_credenciamento,
  case when v.cd_prestador is not null then coalesce((select try_cast(min(e.cd_cnes) as bigint) from fx_address e
    where e.cd_prestador = v.cd_prestador and e.sn_principal = 'S' and e.cd_cnes is not null), 9999999) end as nr_cnes
from {p}asked q
left join (select q.cd_tiss_demnstrv_retorno as k, count(*) as n, max(r.cd_prestador) as cd
  from {p}asked q join fx_provider r on r.tp_situacao = 'A' and r.cd_multi_empresa = q.cd_multi_empresa
    and (r.cd_interno = cast(q.cd_prestador_contratado as varchar) or r.cd_prestador = q.cd_prestador_contratado)
  group by 1) x on x.k = q.cd_tiss_demnstrv_retorno
left join fx_provider v on v.cd_prestador = x.cd and x.n = 1""")
    step(f"{p}body", f"""
select *, case when nr_prestadores <> 1 then '1203' end as b_cd,
  case when nr_prestadores = 0 then 'CÓDIGO PRESTADOR INVÁLIDO'
    when nr_prestadores > 1 then 'PRESTADOR COM MAIS DE UM REGISTRO. ENTRE EM CONTATO COM A OPERADORA' end as b_ds
from {p}contracted""")
    step(f"{p}error_ana", f"""
select cd_tiss_demnstrv_retorno, id, coalesce(g_cd, b_cd) as cd_motivo_glosa,
  case when g_cd is not null then g_ds else b_ds end as ds_motivo_glosa
from {p}body where coalesce(g_cd, b_cd) is not null and tp_demonstrativo in ('2', '3')""")
    step(f"{p}fine", f"select * from {p}body where g_cd is null and b_cd is null and tp_demonstrativo in ('2', '3')")
    step(f"{p}proto", f"select f.*, k.nr_protocolo from {p}fine f join fx_req_proto k on k.cd_pai = f.cd_tiss_demnstrv_retorno")
    step(f"{p}pv", f"""
select f.* exclude (rn),
  case when t.cd_protocolo_ctamed is null or t.cd_prestador <> f.cd_prestador then '5013' end as g_protocolo_cd,
  case when t.cd_protocolo_ctamed is null then 'PROTOCOLO NÃO ENCONTRADO' when t.cd_prestador <> f.cd_prestador
    then 'PROTOCOLO NÃO PERTENCE AO PRESTADOR DE CÓDIGO ' || cast(f.cd_prestador as varchar) end as g_protocolo_ds,
  case when t.cd_protocolo_ctamed is null or t.cd_prestador <> f.cd_prestador then 7 else t.cd_status_protocolo end
    as cd_status_protocolo,
  case when t.cd_protocolo_ctamed is null then cast(f.dt_solicitacao as timestamp) else t.dt_envio_lote end as dt_envio_lote,
  case when t.cd_protocolo_ctamed is null then 0 else t.nr_lote_prestador end as nr_lote_prestador, t.cd_glosa_protocolo,
  (select min(l.cd_lote) from fx_lot l where l.cd_protocolo_ctamed = f.nr_protocolo) as cd_lote
from {p}proto f
left join (select t.* from fx_protocol t join fx_provider r on r.cd_prestador = t.cd_prestador) t
  on t.cd_protocolo_ctamed = f.nr_protocolo""")
    step(f"{p}pair", f"select distinct nr_protocolo, cd_prestador as pedido from {p}pv where g_protocolo_cd is null")
    step(f"{p}pc", f"""
select c.*, w.nr_protocolo, w.pedido, l.cd_fatura as fatura_lote, coalesce(c.cd_prestador, c.cd_prestador_principal) as pago_a
from fx_claim c join fx_lot l on l.cd_lote = c.cd_lote join {p}pair w on w.nr_protocolo = l.cd_protocolo_ctamed""")
    step(f"{p}tot", f"""
select * from (
  select nr_protocolo, pedido, x.cd_fatura as fat, c.cd_fatura as cta, sum(vl_total_cobrado) as vl_cobrado,
    sum(vl_total_glosado) as vl_glosado,
    (select sum(v.vl_total_pago) from {p}pc v where v.nr_protocolo = c.nr_protocolo and v.pedido = c.pedido
       and v.pago_a = c.pedido) as vl_pago,
    row_number() over (partition by nr_protocolo, pedido order by x.cd_fatura nulls last, c.cd_fatura nulls last) as rn
  from {p}pc c left join fx_invoice x on x.cd_fatura = c.fatura_lote
  where c.cd_prestador_principal = c.pedido and c.tp_situacao not in ('NA', 'GA')
  group by nr_protocolo, pedido, x.cd_fatura, c.cd_fatura) where rn = 1""")
    found = "v.g_protocolo_cd is null and v.cd_status_protocolo in (3, 6) and t.nr_protocolo is not null"
    step(f"{p}pt", f"""
select v.*, case when v.g_protocolo_cd is not null then v.g_protocolo_cd when {found} then v.cd_glosa_protocolo end
    as cd_motivo_glosa,
  case when v.g_protocolo_cd is not null then v.g_protocolo_ds when {found} then g.ds_glosa end as ds_motivo_glosa,
  case when v.g_protocolo_cd is null and v.cd_status_protocolo in (3, 6) and t.nr_protocolo is null then 2
    else v.cd_status_protocolo end as cd_status_final,
  case when {found} then t.vl_cobrado else 0 end as vl_informado_protocolo,
  case when {found} then t.vl_cobrado else 0 end as vl_processado_protocolo,
  case when {found} then t.vl_pago else 0 end as vl_protocolo,
  case when {found} then t.vl_glosado else 0 end as vl_glosa_protocolo
from {p}pv v
left join {p}tot t on t.nr_protocolo = v.nr_protocolo and t.pedido = v.cd_prestador
left join fx_denial g on g.cd_glosa = v.cd_glosa_protocolo""")
    step(f"{p}released", f"""
select distinct cd_conta_medica, cd_lote from {p}pc where tp_origem = 2 and cd_motivo is null and vl_total_pago > 0""")
    step(f"{p}inner", f"""
select nr_protocolo, pedido as cd_prestador, c.cd_guia_externa, c.nr_guia, u.nm_segurado, u.cd_matricula as mat,
  c.nm_beneficiario, c.vl_total_cobrado, c.nr_carteira_beneficiario, c.dt_entrada, c.dt_saida, c.dt_realizado,
  r.nm_prestador, g.sn_atendimento_recem_nato, c.cd_conta_medica, c.cd_lote, c.id_tiss_item,
  sum(c.qt_cobrado * c.vl_unit_cobrado) as vl_processado, sum(c.vl_total_glosado) as vl_glosado
from {p}pc c left join fx_provider r on r.cd_prestador = c.cd_prestador
left join fx_guide g on g.nr_guia = c.nr_guia left join fx_member u on u.cd_matricula = g.cd_matricula
where c.tp_situacao not in ('NA', 'GA') and c.cd_prestador = c.pedido
group by all""")
    step(f"{p}gkey", f"select distinct nr_protocolo, cd_prestador, cd_guia_externa, nr_guia from {p}inner")
    step(f"{p}gpaid", f"""
select k.nr_protocolo, k.cd_prestador, k.cd_guia_externa, k.nr_guia, sum(v.vl_total_pago) as vl_liberado
from {p}gkey k left join {p}pc v on v.nr_protocolo = k.nr_protocolo and v.pedido = k.cd_prestador
  and v.pago_a = k.cd_prestador and (v.cd_guia_externa = k.cd_guia_externa or v.nr_guia = k.nr_guia)
group by all""")
    step(f"{p}guide", f"""
select i.nr_protocolo, i.cd_prestador, i.cd_guia_externa, i.nr_guia, coalesce(i.nm_segurado, i.nm_beneficiario) as nm_beneficiario,
  coalesce(cast(i.mat as varchar), i.nr_carteira_beneficiario) as nr_carteira, i.dt_entrada as dt_inicio_fat,
  i.dt_saida as dt_fim_fat, i.dt_realizado as dt_realizacao, i.nm_prestador as nm_contratado, i.sn_atendimento_recem_nato,
  case when f.cd_lote is null then 'N' else 'S' end as sn_liberado,
  case when f.cd_lote is null then 2 else 5 end as cd_status_guia,
  sum(i.vl_processado) as vl_processado, sum(k.vl_liberado) as vl_liberado, sum(i.vl_glosado) as vl_glosado,
  sum(i.vl_total_cobrado) as vl_informado
from {p}inner i left join {p}released f on f.cd_conta_medica = i.cd_conta_medica and f.cd_lote = i.cd_lote
left join {p}gpaid k on k.nr_protocolo = i.nr_protocolo and k.cd_prestador = i.cd_prestador
  and k.cd_guia_externa is not distinct from i.cd_guia_externa and k.nr_guia is not distinct from i.nr_guia
group by all""")
    step(f"{p}proc", f"""
select k.nr_protocolo, k.cd_prestador, k.cd_guia_externa, k.nr_guia, c.cd_lancamento, c.dt_realizado, c.cd_procedimento,
  c.ds_procedimento, c.cd_motivo, c.cd_atividade_medica, c.vl_total_cobrado, c.vl_unit_pago,
  sum(c.vl_total_cobrado) as vl_informado, sum(c.vl_total_pago) as vl_liberado, sum(c.vl_total_glosado) as vl_glosa,
  sum(c.qt_pago) as qt_executada
from {p}gkey k join {p}pc c on c.nr_protocolo = k.nr_protocolo and c.pedido = k.cd_prestador and c.pago_a = k.cd_prestador
  and (c.nr_guia = k.nr_guia or c.cd_guia_externa = k.cd_guia_externa)
where c.tp_situacao not in ('NA', 'GA') group by all""")
    tables = " union ".join(f"select '{c}' as tabela, cd_procedimento from fx_proctable_{c}" for c in ("18", "19", "20", "22"))
    step(f"{p}proct", f"""
select q.*, coalesce((select min(b.tabela) from ({tables}) b where b.cd_procedimento = q.cd_procedimento), '00')
  as cd_tipo_tabela from {p}proc q""")
    step(f"{p}reason", f"""
select q.*, case when r.cd_motivo is not null then coalesce(r.cd_tiss, 'TODO_CD_TISS') end as cd_motivo_glosa,
  r.ds_motivo as ds_motivo_glosa
from {p}proct q left join fx_reason r on r.cd_motivo = q.cd_motivo where q.cd_motivo is not null""")

    def total(c: str) -> str:
        return f"case when count(*) filter (where t.nr_protocolo is not null) = 0 then 0 when count(*) = count(t.{c}) then sum(t.{c}) end"

    step(f"{p}stot", f"""
select f.cd_tiss_demnstrv_retorno, f.id, f.nr_registro_ans, f.ds_operadora, f.nr_cnpj_operadora, '2024-01-31' as dt_emissao,
  f.cd_prestador, f.nm_prestador as ds_prestador, f.nr_cnes as nr_cnes_prestador,
  {total("vl_informado_protocolo")} as vl_informado_geral, {total("vl_processado_protocolo")} as vl_processado_geral,
  {total("vl_protocolo")} as vl_liberado_geral, {total("vl_glosa_protocolo")} as vl_glosa_geral
from {p}fine f left join {p}pt t on t.cd_tiss_demnstrv_retorno = f.cd_tiss_demnstrv_retorno
group by f.cd_tiss_demnstrv_retorno, f.id, f.nr_registro_ans, f.ds_operadora, f.nr_cnpj_operadora, f.cd_prestador,
  f.nm_prestador, f.nr_cnes""")
    step(f"{p}out_proto", f"""
select cd_tiss_demnstrv_retorno, nr_lote_prestador as nr_lote, nr_protocolo, strftime(dt_envio_lote, '%Y-%m-%d') as dt_envio_lote,
  cd_motivo_glosa as cd_motivo_glosa_protocolo, ds_motivo_glosa, cd_status_final as cd_status_protocolo,
  vl_informado_protocolo, vl_processado_protocolo, vl_protocolo, vl_glosa_protocolo from {p}pt""")
    step(f"{p}open", f"select cd_tiss_demnstrv_retorno, nr_protocolo, cd_prestador from {p}pt where cd_motivo_glosa is null")
    step(f"{p}og", f"""
select o.cd_tiss_demnstrv_retorno, g.* from {p}open o join {p}guide g on g.nr_protocolo = o.nr_protocolo
  and g.cd_prestador = o.cd_prestador""")
    step(f"{p}out_guide", f"""
select cd_tiss_demnstrv_retorno, nr_protocolo, cd_guia_externa as nr_guia_prestador, nr_guia as nr_guia_operadora,
  nr_guia as nr_senha, nm_beneficiario, nr_carteira as nr_numero_carteira, dt_inicio_fat,
  strftime(dt_inicio_fat, '%I:%m:%S') as hr_inicio_fat, dt_fim_fat, strftime(dt_fim_fat, '%I:%m:%S') as hr_fim_fat,
  cd_status_guia as cd_status_protocolo, vl_informado as vl_informado_guia, vl_processado as vl_processado_guia,
  vl_liberado as vl_liberado_guia, vl_glosado as vl_glosa_guia from {p}og""")
    for grain, rows in (("proc", "proct"), ("denial", "reason")):
        step(f"{p}out_{grain}", f"""
select g.cd_tiss_demnstrv_retorno, g.nr_protocolo, g.cd_guia_externa as nr_guia_prestador, g.nr_guia as nr_guia_operadora,
  g.nm_beneficiario, g.nr_carteira, g.dt_inicio_fat, g.dt_fim_fat, g.dt_realizacao, g.cd_status_guia,
  q.* exclude (nr_protocolo, cd_prestador, cd_guia_externa, nr_guia), q.dt_realizado as dt_execucao,
  q.cd_atividade_medica as cd_grau_participacao, q.vl_informado as vl_processado
from {p}og g join {p}{rows} q on q.nr_protocolo = g.nr_protocolo and q.cd_prestador = g.cd_prestador
  and q.cd_guia_externa is not distinct from g.cd_guia_externa and q.nr_guia is not distinct from g.nr_guia""")

    # payment
    bad = "dt_competencia is not null and try_strptime(dt_competencia || '01', '%Y%m%d') is null"
    step(f"{p}period", f"""
select *, case when {bad} then null else substring(dt_competencia, 5, 2) || substring(dt_competencia, 1, 4) end as nr_periodo,
  dt_pagamento as dt_dia, case when {bad} then '5013' end as g_periodo_cd,
  case when {bad} then 'DATA DE COMPETENCIA SOLICITADA INVÁLIDA' end as g_periodo_ds
from {p}contracted where tp_demonstrativo = '1'""")
    step(f"{p}pbody", f"""
select *, case when g_periodo_cd is not null then g_periodo_cd when nr_prestadores <> 1 then '1203' end as b_cd,
  case when g_periodo_cd is not null then g_periodo_ds when nr_prestadores = 0 then 'CÓDIGO PRESTADOR INVÁLIDO'
    when nr_prestadores > 1 then
    'CÓDIGO PRESTADOR INVÁLIDO/PRESTADOR COM MAIS DE UM REGISTRO. ENTRE EM CONTATO COM A OPERADORA' end as b_ds
from {p}period""")
    step(f"{p}pfine", f"select * from {p}pbody where g_cd is null and b_cd is null")

    def folha(v: str, tenant: str) -> str:
        return (f"exists (select 1 from fx_config c where c.chave = 'CONTMED_FOLHA_PGTO' and c.valor = '{v}'"
                f" and c.cd_multi_empresa = {tenant})")

    def asked(c: str, exact: bool) -> str:
        day = f"{c} = q.dt_dia" if exact else f"strftime({c}, '%m%Y') = strftime(q.dt_dia, '%m%Y')"
        return f"((q.dt_dia is null and strftime({c}, '%m%Y') = q.nr_periodo) or (q.dt_dia is not null and {day}))"

    head = ("select distinct q.cd_tiss_demnstrv_retorno, q.id, q.cd_prestador, q.cd_multi_empresa, q.tp_credenciamento, ")
    step(f"{p}dates", f"""
{head} y.dt_pagamento as dt_pagamento_feito, 'FATURA' as ramo
from {p}pfine q join fx_transfer t on t.cd_prestador = q.cd_prestador
join fx_invoice f on f.cd_fatura = t.cd_fatura and f.cd_multi_empresa = q.cd_multi_empresa
join fx_payable a on a.cd_con_pag = t.cd_con_pag join fx_payable_item i on i.cd_con_pag = a.cd_con_pag
join fx_payment y on y.cd_itcon_pag = i.cd_itcon_pag
where {asked("y.dt_pagamento", True)} and {folha("N", "q.cd_multi_empresa")}
union all
{head} y.dt_pagamento, 'CONTA'
from {p}pfine q join fx_transfer t on t.cd_prestador = q.cd_prestador
join fx_provider r on r.cd_prestador = t.cd_prestador and r.tp_credenciamento <> 'P' and r.cd_multi_empresa = q.cd_multi_empresa
join fx_payable a on a.cd_con_pag = t.cd_con_pag join fx_payable_item i on i.cd_con_pag = a.cd_con_pag
join fx_payment y on y.cd_itcon_pag = i.cd_itcon_pag
where {asked("y.dt_pagamento", True)} and {folha("S", "q.cd_multi_empresa")}
union all
{head} o.dt_competencia, 'PROPRIA'
from {p}pfine q join fx_transfer t on t.cd_prestador = q.cd_prestador
join fx_provider r on r.cd_prestador = t.cd_prestador and r.tp_credenciamento = 'P' and r.cd_multi_empresa = q.cd_multi_empresa
join fx_ownpay o on o.cd_pagamento_prestador = t.cd_pagamento_prestador
where {asked("o.dt_competencia", False)} and {folha("S", "q.cd_multi_empresa")}""")
    own = "(select r.cd_prestador from fx_provider r where r.cd_prestador_guia_web = d.cd_prestador)"
    step(f"{p}items", f"""
select distinct d.*, y.cd_itcon_pag, a.cd_con_pag, 'N' as folha
from {p}dates d join fx_payment y on y.dt_pagamento = d.dt_pagamento_feito
join fx_payable_item i on i.cd_itcon_pag = y.cd_itcon_pag join fx_payable a on a.cd_con_pag = i.cd_con_pag
join fx_transfer t on t.cd_con_pag = a.cd_con_pag
join fx_invoice f on f.cd_fatura = t.cd_fatura and f.cd_multi_empresa = d.cd_multi_empresa
where d.tp_credenciamento <> 'P' and t.cd_prestador in {own} and {folha("N", "d.cd_multi_empresa")}
union all
select distinct d.*, y.cd_itcon_pag, a.cd_con_pag, 'S' as folha
from {p}dates d join fx_payment y on y.dt_pagamento = d.dt_pagamento_feito
join fx_payable_item i on i.cd_itcon_pag = y.cd_itcon_pag
join fx_payable a on a.cd_con_pag = i.cd_con_pag and a.cd_multi_empresa = d.cd_multi_empresa
join fx_transfer t on t.cd_con_pag = a.cd_con_pag
where d.tp_credenciamento <> 'P' and t.cd_prestador in {own} and {folha("S", "d.cd_multi_empresa")}""")
    step(f"{p}transfers", f"""
select distinct t.cd_con_pag, t.cd_repasse_prestador, t.cd_fatura, i.folha
from {p}items i join fx_transfer t on t.cd_con_pag = i.cd_con_pag""")
    informed = ("(select sum(cast(replace(b.vl_total_procedimento, ',', '.') as decimal(18,2))) from fx_batch_guide b"
                " where b.cd_protocolo_ctamed = x.pro)")
    step(f"{p}summary_pay", f"""
select cd_repasse_prestador, folha, dt_protocolo, nr_protocolo, nr_lote, {informed} as vl_informado, vl_liberado, vl_glosa
from (select w.cd_repasse_prestador, 'N' as folha, k.dt_envio_lote as dt_protocolo, l.cd_protocolo_ctamed as nr_protocolo,
    k.nr_lote_prestador as nr_lote, k.cd_protocolo_ctamed as pro, sum(c.vl_total_pago) as vl_liberado,
    sum(c.vl_total_glosado) as vl_glosa
  from (select distinct cd_repasse_prestador, cd_fatura from {p}transfers where folha = 'N') w
  join fx_protocol k on k.cd_fatura = w.cd_fatura join fx_lot l on l.cd_protocolo_ctamed = k.cd_protocolo_ctamed
  join fx_claim c on c.cd_lote = l.cd_lote group by all) x
union all
select cd_repasse_prestador, folha, dt_protocolo, nr_protocolo, nr_lote, coalesce({informed}, vl_liberado), vl_liberado, vl_glosa
from (select c.cd_repasse_prestador, 'S' as folha, coalesce(k.dt_envio_lote, l.dt_lote) as dt_protocolo,
    coalesce(l.cd_protocolo_ctamed, l.cd_lote) as nr_protocolo, coalesce(k.nr_lote_prestador, l.cd_lote) as nr_lote,
    k.cd_protocolo_ctamed as pro, l.cd_lote as lote, sum(c.vl_total_pago) as vl_liberado, sum(c.vl_total_glosado) as vl_glosa
  from (select distinct cd_repasse_prestador from {p}transfers where folha = 'S') w
  join fx_claim c on c.cd_repasse_prestador = w.cd_repasse_prestador join fx_lot l on l.cd_lote = c.cd_lote
  left join fx_protocol k on k.cd_protocolo_ctamed = l.cd_protocolo_ctamed group by all) x""")
    step(f"{p}credits", f"""
select i.cd_tiss_demnstrv_retorno, i.dt_pagamento_feito, i.ramo, i.cd_itcon_pag, i.folha, d.cd_fatura,
  case d.tp_lancamento when 'C' then 1 when 'D' then 2 end as tp_indicador, '08' as tp_debito_credito, d.ds_observacao,
  d.vl_lancamento
from {p}items i join fx_creddeb d on d.cd_fatura in (
  select k.cd_fatura from fx_transfer t join fx_protocol k on k.cd_fatura = t.cd_fatura
  join fx_lot l on l.cd_protocolo_ctamed = k.cd_protocolo_ctamed join fx_claim c on c.cd_lote = l.cd_lote
  where t.cd_con_pag = i.cd_con_pag)""")
    step(f"{p}listed", f"""
select i.*, t.cd_repasse_prestador, s.dt_protocolo, s.nr_protocolo, s.nr_lote, s.vl_informado, s.vl_liberado as vl_processado,
  s.vl_liberado, s.vl_glosa
from {p}items i join fx_transfer t on t.cd_con_pag = i.cd_con_pag
join {p}summary_pay s on s.cd_repasse_prestador = t.cd_repasse_prestador and s.folha = i.folha""")
    k3 = "cd_tiss_demnstrv_retorno, dt_pagamento_feito, ramo"
    step(f"{p}plain", f"""
select i.*, coalesce(s.a, 0) as vl_informado, coalesce(s.b, 0) as vl_liberado, coalesce(s.c, 0) as vl_glosa,
  coalesce(d.deb, 0) as vl_debitos, coalesce(d.cre, 0) as vl_creditos
from {p}items i
left join (select {k3}, cd_itcon_pag, folha, sum(vl_informado) as a, sum(vl_liberado) as b, sum(vl_glosa) as c
  from {p}listed group by all) s using ({k3}, cd_itcon_pag, folha)
left join (select {k3}, cd_itcon_pag, folha, sum(vl_lancamento) filter (where tp_indicador = 2) as deb,
  sum(vl_lancamento) filter (where tp_indicador = 1) as cre from {p}credits group by all) d using ({k3}, cd_itcon_pag, folha)""")
    run = f"over (partition by {k3} order by cd_itcon_pag, folha rows between unbounded preceding and current row)"
    step(f"{p}carried", f"""
select * replace (sum(vl_informado) {run} as vl_informado, sum(vl_liberado) {run} as vl_liberado, sum(vl_glosa) {run} as vl_glosa)
from {p}plain""")
    step(f"{p}ptot", f"""
select d.cd_tiss_demnstrv_retorno, coalesce(sum(c.vl_informado), 0) as vl_informado, coalesce(sum(c.vl_liberado), 0) as vl_liberado,
  coalesce(sum(c.vl_glosa), 0) as vl_glosa, coalesce(sum(c.vl_debitos), 0) as vl_debitos,
  coalesce(sum(c.vl_creditos), 0) as vl_creditos
from (select distinct cd_tiss_demnstrv_retorno from {p}dates) d
left join {p}carried c on c.cd_tiss_demnstrv_retorno = d.cd_tiss_demnstrv_retorno group by 1""")
    step(f"{p}ownnet", f"select *, '1' as tp_forma_pagamento from {p}dates where tp_credenciamento = 'P'")
    step(f"{p}nopay", f"""
select q.cd_tiss_demnstrv_retorno, q.id, '5013' as cd_motivo_glosa, 'NÃO FORAM ENCONTRADOS PAGAMENTOS NA ' ||
  case when q.dt_competencia is null then 'DATA DE PAGAMENTO' else 'COMPETÊNCIA' end || ' FORNECIDA: ' ||
  coalesce(q.dt_competencia, strftime(q.dt_dia, '%d/%m/%Y'), '') as ds_motivo_glosa
from {p}pfine q where not exists (select 1 from {p}dates d where d.cd_tiss_demnstrv_retorno = q.cd_tiss_demnstrv_retorno)""")
    step(f"{p}out_stat", f"""
select q.cd_tiss_demnstrv_retorno, q.id, q.nr_registro_ans, q.ds_operadora, q.nr_cnpj_operadora, '2024-01-31' as dt_emissao,
  q.cd_prestador, q.nm_prestador as ds_prestador, q.nr_cnes as nr_cnes_prestador, t.vl_informado as vl_total_geral_informado,
  t.vl_informado as vl_total_geral_processado, t.vl_liberado as vl_total_geral_liberado, t.vl_glosa as vl_total_geral_glosa,
  t.vl_debitos as vl_total_debitos_dem, t.vl_creditos as vl_total_creditos_dem, t.vl_liberado as vl_liberado_dem,
  t.vl_informado as vl_info_bruto, t.vl_informado as vl_processado_bruto, t.vl_liberado as vl_liberado_bruto,
  t.vl_glosa as vl_glosa_bruto
from {p}pfine q left join {p}ptot t on t.cd_tiss_demnstrv_retorno = q.cd_tiss_demnstrv_retorno""")
    step(f"{p}out_item", f"""
select c.cd_tiss_demnstrv_retorno, c.dt_pagamento_feito, c.ramo, c.cd_itcon_pag, c.folha, d.tp_forma_pagamento, d.cd_banco,
  d.cd_agencia as nr_agencia, d.nr_conta_cheque, c.vl_informado as vl_total_info_item, c.vl_liberado as vl_total_processado_item,
  c.vl_liberado as vl_total_liberado_item, c.vl_glosa as vl_total_glosa_item, c.vl_debitos as vl_total_debitos_item,
  c.vl_creditos as vl_total_creditos_item, c.vl_liberado as vl_liquido_item
from {p}carried c left join o_detail d on d.cd_itcon_pag = c.cd_itcon_pag""")
    step(f"{p}out_credit", f"select *, ds_observacao as ds_debito_credito, vl_lancamento as vl_debito_credito from {p}credits")
    step(f"{p}out_stat_credit", f"select *, ds_observacao as ds_db_cr, vl_lancamento as vl_db_cr from {p}credits")
    step(f"{p}error_pay", f"""
select cd_tiss_demnstrv_retorno, id, coalesce(g_cd, b_cd) as cd_motivo_glosa,
  case when g_cd is not null then g_ds else b_ds end as ds_motivo_glosa
from {p}pbody where coalesce(g_cd, b_cd) is not null
union all select * from {p}nopay""")


statement_steps("o_")
statement_steps("j_")

step("o_valid", "select *, case when nr_prestadores >= 1 then 'TRUE' else 'FALSE' end as sn_prestador_valido from o_contracted")
step("o_payee", """
select cd_conta_medica, cd_lancamento, coalesce(cd_prestador, cd_prestador_principal) as cd_prestador_pago from fx_claim""")
step("o_hours", """
select cd_conta_medica, cd_lancamento, strftime(dt_entrada, '%I:%m:%S') as hr_entrada, strftime(dt_saida, '%I:%m:%S') as hr_saida
from fx_claim""")

# payment form, bank, branch office, account, cheque
step("o_form", """
select cd_itcon_pag, case tp_pagamento when '5' then '1' when '8' then '1' when '1' then '3' when '2' then '3' when '3' then '4'
  when '4' then '4' end as tp_forma_pagamento
from (select *, row_number() over (partition by cd_itcon_pag order by cd_pagcon_pag) as rn from fx_payment) where rn = 1""")
for _name, _pay, _sup in (("bank", "cd_banco_forn", "cd_banco"), ("agency", "cd_agencia_forn", "cd_agencia"),
                          ("account", "nr_conta_forn", "nr_conta")):
    step(f"o_{_name}", f"""
select cd_itcon_pag, case when count(*) = 1 then max(v) end as {_sup}
from (select distinct 1 as src, cd_itcon_pag, {_pay} as v from fx_payment where {_pay} is not null
  union all
  select distinct 2, i.cd_itcon_pag, s.{_sup} from fx_payable_item i join fx_payable p on p.cd_con_pag = i.cd_con_pag
  join fx_supplier s on s.cd_fornecedor = p.cd_fornecedor where s.{_sup} is not null
  {"and s.cd_banco in (select cd_banco from fx_bank)" if _name == "bank" else ""})
group by cd_itcon_pag""")
step("o_cheque", """
select i.cd_itcon_pag, a.nr_conta, case when k.n > 1 then null when k.n = 1 then k.c else a.nr_conta end as nr_conta_cheque
from fx_payable_item i left join o_account a on a.cd_itcon_pag = i.cd_itcon_pag
left join (select cd_itcon_pag, count(distinct cd_cheque) as n, max(cd_cheque) as c from fx_payment where cd_cheque is not null
  group by 1) k on k.cd_itcon_pag = i.cd_itcon_pag""")
step("o_detail", """
select c.cd_itcon_pag, f.tp_forma_pagamento, b.cd_banco, g.cd_agencia, c.nr_conta_cheque
from o_cheque c left join o_form f using (cd_itcon_pag) left join o_bank b using (cd_itcon_pag)
left join o_agency g using (cd_itcon_pag)""")

# failures, on messages whose older versions send the older date form
request_steps("f_", "fx_message_mixed")
step("f_log", f"""
select row_number() over (order by id) as cd_tiss_mensagem_log, cd_tiss_demnstrv_retorno, id, id as cd_tiss_mensagem,
  {AS_OF} as dt_log, 'ERRO: DATA/HORA DA TRANSACAO INVALIDA: HORA INVALIDA' as ds_log from f_request where ilegivel""")
step("f_error", """
select cd_tiss_demnstrv_retorno, id, '5013' as cd_motivo_glosa,
  'OCORREU UM ERRO NO PROCESSAMENTO DA SUA REQUISIÇÃO. ERRO CÓD: ' || cast(cd_tiss_mensagem_log as varchar) as ds_motivo_glosa
from f_log""")
step("j_errors", """
select * from j_error_ana union all select * from j_error_pay
union all select cd_tiss_demnstrv_retorno, id, g_cd, g_ds from j_gated where ds_destino = 'ERRO'""")
# stored statements, each row with what stands above it
step("j_stored_proc", """
select q.id, p.nr_protocolo, p.nr_guia_prestador, p.nr_guia_operadora, p.nm_beneficiario, p.dt_inicio_fat, g.vl_liberado_guia,
  p.dt_execucao as dt_realizacao, p.cd_tipo_tabela, p.cd_procedimento, p.ds_procedimento, p.vl_informado, p.qt_executada,
  p.vl_processado, p.vl_liberado
from j_out_proc p join j_gated q using (cd_tiss_demnstrv_retorno)
join (select distinct cd_tiss_demnstrv_retorno, nr_protocolo, nr_guia_prestador, nr_guia_operadora, vl_liberado_guia, nm_beneficiario,
    nr_numero_carteira, dt_inicio_fat, dt_fim_fat, cd_status_protocolo, dt_realizacao from j_out_guide) g
  on g.cd_tiss_demnstrv_retorno = p.cd_tiss_demnstrv_retorno and g.nr_protocolo = p.nr_protocolo
  and g.nr_guia_prestador is not distinct from p.nr_guia_prestador and g.nr_guia_operadora is not distinct from p.nr_guia_operadora
  and g.nm_beneficiario is not distinct from p.nm_beneficiario and g.nr_numero_carteira is not distinct from p.nr_carteira
  and g.dt_inicio_fat is not distinct from p.dt_inicio_fat and g.dt_fim_fat is not distinct from p.dt_fim_fat
  and g.cd_status_protocolo is not distinct from p.cd_status_guia and g.dt_realizacao is not distinct from p.dt_realizacao""")
step("j_stored_denial", "select q.id, d.* from j_out_denial d join j_gated q using (cd_tiss_demnstrv_retorno)")
step("j_stored_summary", """
select l.id, l.dt_pagamento_feito as dt_pagamento, c.vl_informado as vl_total_info_item, l.dt_protocolo, l.nr_protocolo, l.nr_lote,
  l.vl_informado, l.vl_processado, l.vl_liberado, l.vl_glosa
from j_listed l join j_carried c using (cd_tiss_demnstrv_retorno, dt_pagamento_feito, ramo, cd_itcon_pag, folha)""")
step("j_stored_credit", """
select s.id, c.dt_pagamento_feito as dt_pagamento, s.vl_total_geral_informado, c.tp_indicador, c.tp_debito_credito,
  c.ds_debito_credito, c.vl_debito_credito
from j_out_credit c join j_out_stat s using (cd_tiss_demnstrv_retorno)""")
step("f_reply", """
select f.cd_tiss_demnstrv_retorno, f.id as cd_tiss_mensagem_origem, '999999' as nr_registro_ans, c.valor as cd_versao,
  '999999' as cd_prestador, '5013' as cd_glosa, e.ds_motivo_glosa as ds_glosa
from f_log f join f_error e on e.id = f.id left join fx_config c on c.chave = 'VERSAO_TISS' and c.cd_multi_empresa = 1""")

# --- ledger -----------------------------------------------------------------------

step("o_account_name", f"""
select q.id, coalesce(case when y.id is not null then y.ds_conta else l.ds_conta end, 'NAO ENCONTRADO') as ds_conta
from fx_account_request q
left join (select q.id, p.ds_conta, row_number() over (partition by q.id order by p.cd_plano, p.cd_reduzido) as rn
  from fx_account_request q join fx_chart p on p.cd_contabil = '1.2.1'
    and (p.cd_contabil = q.cd_contabil or p.cd_reduzido = q.cd_reduzido)
  join fx_closed_month m on m.cd_plano = p.cd_plano and m.cd_multi_empresa = {TENANT}
    and date_trunc('year', m.dt_ano) = date_trunc('year', q.dt_referencia) and m.dt_mes = strftime(q.dt_referencia, '%m')
  ) y on y.id = q.id and y.rn = 1
left join (select q.id, p.ds_conta, row_number() over (partition by q.id order by p.cd_reduzido) as rn
  from fx_account_request q join fx_ledger p on (p.cd_contabil = q.cd_contabil or p.cd_reduzido = q.cd_reduzido)
    and p.cd_multi_empresa = {TENANT}) l on l.id = q.id and l.rn = 1""")
