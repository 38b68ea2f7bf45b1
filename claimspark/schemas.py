"""Explicit schemas of the domain tables and of the result tables.

Column names follow the source system. Money is decimal(18,2), codes are bigint,
dates that the source keeps as text stay text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Codes of the procedure tables, one table each: fixed values.
PROCEDURE_TABLES = ("18", "19", "20", "22")

# Columns of each table, in table order: fixed values.
INPUTS: dict[str, str] = {
    "notice": """cd_ressarcimento_sus bigint, ds_oficio string, dt_oficio date, vl_oficio decimal(18,2),
        dt_compet_inicial date, dt_compet_final date, nr_processo_oficio string, nr_gru bigint, dt_gru date,
        dt_emissao date, dt_vencimento date, vl_gru decimal(18,2), cd_tip_doc bigint, nr_doc_gru bigint,
        cd_fornecedor bigint, cd_usuario_inclusao string, dh_inclusao timestamp_ntz, cd_usuario_alteracao string,
        dh_ultima_alteracao timestamp_ntz, ds_oficio_gru string, cd_con_pag bigint, cd_multi_empresa bigint,
        cd_fatura_abi bigint, cd_fatura_gru bigint""",
    "attach": """cd_ressarcimento_sus_anexo bigint, cd_ressarcimento_sus bigint, ds_arquivo string,
        cd_usuario_inclusao string, dt_inclusao timestamp_ntz""",
    "item": """cd_item_ressarciment_sus_anexo bigint, cd_ressarcimento_sus_anexo bigint, nm_ups string,
        nm_municipio string, cd_uf string, nr_competencia string, tp_atendimento string, nr_atendimento bigint,
        dt_inicio timestamp_ntz, dt_fim timestamp_ntz, cd_carater bigint, cd_beneficiario string, cd_cco bigint,
        dt_nasc_beneficiario date, cd_procedimento bigint, ds_procedimento string, vl_procedimento decimal(18,2),
        ds_atendimento string, vl_total decimal(18,2), cd_ressarcimento_sus bigint, cd_reembolso bigint,
        sn_confirmar string, tp_procedimento string""",
    "validation": """cd_valida_item_ress_sus_anexo bigint, cd_item_ressarciment_sus_anexo bigint,
        tp_validacao string, ds_mensagem string, dt_validacao timestamp_ntz""",
    "history": """cd_historico_ressarcimento_sus bigint, cd_ressarcimento_sus bigint, ds_observacao string,
        cd_usuario string, dh_ultima_alteracao timestamp_ntz""",
    "staging": "cd_item_ress_sus_anexo bigint",
    "reimb": "cd_reembolso bigint, cd_ressarcimento_sus bigint, tp_status string",
    "reimb_item": """cd_reembolso bigint, cd_procedimento bigint, vl_cobrado decimal(18,2),
        vl_procedimento decimal(18,2)""",
    "member": """cd_matricula bigint, cd_cco bigint, nr_div_cco bigint, nm_segurado string,
        cd_mat_alternativa string, cd_matricula_tem bigint, cd_fornecedor bigint, cd_multi_empresa bigint,
        nr_cns string""",
    "depara": "cd_procedimento_sus bigint, cd_procedimento bigint, dt_inicio_vigencia date, dt_fim_vigencia date",
    "doctype": "cd_tip_doc bigint, ds_tip_doc string, sn_ativo string",
    "supplier": """cd_fornecedor bigint, nm_fornecedor string, sn_ativo string, cd_banco bigint,
        cd_agencia string, nr_conta string""",
    "bank": "cd_banco bigint",
    "provider": """cd_prestador bigint, nr_cpf_cgc bigint, cd_interno string, cd_registro_ans_intermed string,
        nm_prestador string, tp_situacao string, tp_credenciamento string, cd_prestador_guia_web bigint,
        cd_multi_empresa bigint""",
    "termination": "cd_prestador bigint, dt_desligamento date, dt_reativacao date",
    "address": "cd_prestador_endereco bigint, cd_prestador bigint, sn_principal string, cd_cnes string",
    "address_authoriser": "cd_prestador_endereco bigint, cd_autorizador bigint",
    "authoriser": "cd_autorizador bigint, ds_senha string",
    "insurer": "cd_multi_empresa bigint, nr_ans bigint",
    "company": "cd_multi_empresa bigint, cd_cgc bigint, ds_multi_empresa string",
    "config": "chave string, cd_multi_empresa bigint, valor string",
    "message": """id bigint, cd_versao string, nr_registro_ans_destino string, nr_cnpj_pagador_destino string,
        cd_prestador_operadora string, nr_cnpj_prestador_operadora string, nr_cpf_prestador_operadora string,
        nr_registro_ans_origem string, ds_login_prestador string, ds_senha_prestador string,
        nr_ws_ip_remetente string, dt_transacao string, hr_transacao string""",
    "request": """cd_tiss_demnstrv_retorno bigint, cd_pai bigint, tp_demonstrativo string,
        cd_prestador_contratado bigint, nr_cnpj_contratado string, nr_cpf_contratado string,
        dt_competencia string, dt_pagamento date, dt_solicitacao date""",
    "req_proto": "cd_pai bigint, nr_protocolo bigint",
    "protocol": """cd_protocolo_ctamed bigint, cd_prestador bigint, dt_envio_lote timestamp_ntz,
        cd_status_protocolo bigint, cd_glosa_protocolo string, nr_lote_prestador bigint, cd_fatura bigint""",
    "lot": "cd_lote bigint, cd_protocolo_ctamed bigint, dt_lote timestamp_ntz, cd_fatura bigint",
    "invoice": "cd_fatura bigint, cd_multi_empresa bigint",
    "denial": "cd_glosa string, ds_glosa string",
    "claim": """cd_conta_medica bigint, cd_lancamento bigint, cd_lote bigint, cd_fatura bigint,
        cd_repasse_prestador bigint, nr_guia bigint, cd_guia_externa string, cd_prestador bigint,
        cd_prestador_principal bigint, nm_prestador string, cd_matricula bigint, tp_situacao string,
        tp_origem bigint, cd_motivo bigint, cd_tabela string, cd_procedimento bigint, ds_procedimento string,
        cd_atividade_medica bigint, dt_entrada timestamp_ntz, dt_saida timestamp_ntz, dt_realizado timestamp_ntz,
        id_tiss_item bigint, nm_beneficiario string, nr_carteira_beneficiario string, qt_cobrado decimal(18,2),
        qt_pago decimal(18,2), vl_unit_cobrado decimal(18,2), vl_unit_pago decimal(18,2),
        vl_total_cobrado decimal(18,2), vl_total_glosado decimal(18,2), vl_total_pago decimal(18,2)""",
    "guide": "nr_guia bigint, cd_matricula bigint, sn_atendimento_recem_nato string",
    "batch_guide": "cd_protocolo_ctamed bigint, vl_total_procedimento string",
    "reason": "cd_motivo bigint, ds_motivo string, cd_tiss string",
    **{f"proctable_{code}": "cd_procedimento bigint" for code in PROCEDURE_TABLES},
    "transfer": """cd_repasse_prestador bigint, cd_fatura bigint, cd_prestador bigint, cd_con_pag bigint,
        cd_pagamento_prestador bigint""",
    "ownpay": "cd_pagamento_prestador bigint, dt_competencia date",
    "payable": "cd_con_pag bigint, cd_fornecedor bigint, cd_multi_empresa bigint",
    "payable_item": "cd_itcon_pag bigint, cd_con_pag bigint",
    "payment": """cd_pagcon_pag bigint, cd_itcon_pag bigint, dt_pagamento date, tp_pagamento string,
        cd_banco_forn bigint, cd_agencia_forn string, nr_conta_forn string, cd_cheque string""",
    "creddeb": "cd_fatura bigint, tp_lancamento string, ds_observacao string, vl_lancamento decimal(18,2)",
    "chart": "cd_plano bigint, cd_contabil string, cd_reduzido bigint, ds_conta string",
    "closed_month": "cd_plano bigint, cd_multi_empresa bigint, dt_ano date, dt_mes string",
    "ledger": "cd_reduzido bigint, cd_contabil string, ds_conta string, cd_multi_empresa bigint",
    "account_request": "id bigint, cd_contabil string, cd_reduzido bigint, dt_referencia date",
}

# Columns of each result table, in table order: fixed values.
OUTPUTS: dict[str, str] = {
    "reimbursement": """cd_reembolso bigint, tp_reembolso string, cd_controle_interno bigint, cd_matricula bigint,
        cd_mens_contrato bigint, sn_quitar_mensalidade string, sn_gerar_con_pag string, cd_prestador bigint,
        ds_prestador string, ds_conselho string, ds_codigo_conselho string, nr_cpf_cnpj string,
        dt_atendimento timestamp_ntz, vl_ch decimal(18,2), vl_filme decimal(18,2), vl_total_original decimal(18,2),
        cd_con_pag bigint, dt_cancelamento date, ds_usuario_cancelamento string, dt_inclusao date,
        cd_usuario_inclusao string, dt_ultima_atualizacao date, cd_usuario_ultima_atualizacao string,
        ds_observacao string, cd_fornecedor bigint, cd_especialidade bigint, dt_vencimento date, cd_tip_doc bigint,
        cd_multi_empresa bigint, cd_sip_periodo bigint, cd_tipo_atendimento bigint, dt_alta timestamp_ntz,
        tp_pessoa string, tp_status string, cd_tipo_endereco bigint, nr_cep string, ds_endereco string,
        nr_endereco string, ds_complemento string, ds_bairro string, cd_municipio bigint, ds_municipio string,
        cd_uf string, ds_email string, nr_telefone string, cd_ressarcimento_sus bigint, cd_reembolso_pai bigint,
        sn_notificado string, sn_recusado string, nm_banco string, cd_agencia string, dv_agencia string,
        nr_conta string, dv_conta_corrente string, ds_consideracoes_internas string, cd_solicitacao_web bigint,
        cd_banco bigint, cd_tabela bigint, ds_recibo_nota_fiscal string, cd_atend_call_center bigint,
        nr_protocolo_ans string, cd_exp_contabilidade bigint, tp_status_reembolso string""",
    "reimbursement_item": """cd_reembolso bigint, cd_procedimento bigint, vl_procedimento decimal(18,2),
        cd_reduzido_ec bigint, cd_reduzido_re bigint, cd_exp_contabilidade bigint, cd_setor bigint,
        cd_item_res bigint, qt_cobrado bigint, vl_cobrado decimal(18,2), vl_coparticipacao decimal(18,2),
        ds_adicional string, cd_usuario_inclusao string, dt_usuario_inclusao date""",
    "reimbursement_denial": """cd_itreembolso_glosa bigint, cd_reembolso bigint, cd_procedimento bigint,
        cd_motivo bigint, cd_usuario_inclusao string, dt_usuario_inclusao date""",
    "reply": """id bigint, cd_tiss_mensagem_origem bigint, tp_transacao string, nm_xml string, nr_registro_ans string,
        nr_cnpj_operadora string, cd_versao string, cd_prestador string, nr_cnpj_prestador string,
        nr_cpf_prestador string, cd_glosa string, ds_glosa string""",
    "analysis_statement": """id bigint, id_pai bigint, nr_registro_ans bigint, nr_demonstrativo bigint,
        ds_operadora string, nr_cnpj_operadora string, dt_emissao string, cd_prestador bigint, ds_prestador string,
        nr_cnes_prestador bigint, vl_informado_geral decimal(18,2), vl_processado_geral decimal(18,2),
        vl_liberado_geral decimal(18,2), vl_glosa_geral decimal(18,2)""",
    "analysis_protocol": """id bigint, cd_tiss_dem_ana bigint, nr_lote bigint, nr_protocolo bigint,
        dt_envio_lote string, cd_motivo_glosa_protocolo string, ds_motivo_glosa string, cd_status_protocolo bigint,
        vl_informado_protocolo decimal(18,2), vl_processado_protocolo decimal(18,2), vl_protocolo decimal(18,2),
        vl_glosa_protocolo decimal(18,2)""",
    "analysis_guide": """id bigint, id_pai bigint, nr_guia_prestador string, nr_guia_operadora bigint, nr_senha bigint,
        nm_beneficiario string, nr_numero_carteira string, dt_inicio_fat timestamp_ntz, hr_inicio_fat string,
        dt_fim_fat timestamp_ntz, hr_fim_fat string, cd_status_protocolo bigint, vl_informado_guia decimal(18,2),
        vl_processado_guia decimal(18,2), vl_liberado_guia decimal(18,2), vl_glosa_guia decimal(18,2)""",
    "analysis_procedure": """id bigint, id_pai bigint, dt_realizacao timestamp_ntz, cd_tipo_tabela string,
        cd_procedimento bigint, ds_procedimento string, cd_grau_participacao bigint, vl_informado decimal(18,2),
        qt_executada decimal(18,2), vl_processado decimal(18,2), vl_liberado decimal(18,2)""",
    "analysis_denial": """id bigint, id_pai bigint, cd_motivo_glosa string, ds_motivo_glosa string,
        vl_glosa decimal(18,2)""",
    "payment_statement": """id bigint, id_pai bigint, nr_registro_ans bigint, nr_demonstrativo bigint,
        ds_operadora string, nr_cnpj_operadora string, dt_emissao string, cd_prestador bigint, ds_prestador string,
        nr_cnes_prestador bigint, vl_total_geral_informado decimal(18,2), vl_total_geral_processado decimal(18,2),
        vl_total_geral_liberado decimal(18,2), vl_total_geral_glosa decimal(18,2), vl_total_debitos_dem decimal(18,2),
        vl_total_creditos_dem decimal(18,2), vl_liberado_dem decimal(18,2), vl_info_bruto decimal(18,2),
        vl_processado_bruto decimal(18,2), vl_liberado_bruto decimal(18,2), vl_glosa_bruto decimal(18,2)""",
    "payment_item": """cd_tiss_dem_pgt_item bigint, id_pai bigint, dt_pagamento date, tp_forma_pagamento string,
        cd_banco bigint, nr_agencia string, nr_conta_cheque string, vl_total_info_item decimal(18,2),
        vl_total_processado_item decimal(18,2), vl_total_liberado_item decimal(18,2), vl_total_glosa_item decimal(18,2),
        vl_total_debitos_item decimal(18,2), vl_total_creditos_item decimal(18,2), vl_liquido_item decimal(18,2)""",
    "payment_summary": """cd_tiss_dem_pgt_item_resumo bigint, id_pai bigint, dt_protocolo timestamp_ntz,
        nr_protocolo bigint, nr_lote bigint, vl_informado decimal(18,2), vl_processado decimal(18,2),
        vl_liberado decimal(18,2), vl_glosa decimal(18,2)""",
    "payment_item_credit": """cd_tiss_dem_pgt_item_deb_cre bigint, cd_tiss_dem_pgt_item bigint, tp_indicador bigint,
        tp_debito_credito string, ds_debito_credito string, vl_debito_credito decimal(18,2)""",
    "payment_statement_credit": """cd_tiss_dem_pgt_deb_cre bigint, id_pai bigint, tp_indicador bigint,
        tp_debito_credito string, ds_db_cr string, vl_db_cr decimal(18,2)""",
    "error": """cd_tiss_dem_retorno_erro bigint, cd_tiss_mensagem bigint, cd_motivo_glosa string,
        ds_motivo_glosa string""",
    "log": "cd_tiss_mensagem_log bigint, cd_tiss_mensagem bigint, dt_log date, ds_log string",
}

MODEL = {**INPUTS, **OUTPUTS}


def schema(name: str) -> StructType:
    return StructType.fromDDL(MODEL[name])


def conform(df: DataFrame, name: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns of table ``name`` in order and type; missing ones become NULL.

    ``keep`` carries extra columns (natural keys) along.
    """
    have = set(df.columns)
    wanted = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema(name).fields
    ]
    return df.select(*wanted, *keep)
