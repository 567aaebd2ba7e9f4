"""Fixed values the published data forces on the jobs."""

# The bank tickers kept from the exchange quotes.
BANK_TICKERS = [
    "ITUB3", "ITUB4", "BBDC3", "BBDC4", "BBAS3", "SANB11", "SANB3", "SANB4", "BPAC11", "BIDI11", "BIDI4", "BIDI3",
    "BMGB4", "BRSR3", "BPAN4", "ABCB4", "BMEB3", "BMEB4", "BNBR3", "BSLI3", "BSLI4", "BEES3", "BEES4", "BPAR3",
    "BAZA3", "BRIV3", "BRIV4", "PINE3", "PINE4", "BGIP3", "BGIP4", "IDVL3", "IDVL4", "NUBR33", "MODL11", "BMGB3",
    "BRBI11", "ITSA4", "MODL3", "MODL4", "RPAD3", "RPAD5", "RPAD6", "CRIV3", "CRIV4", "MERC4",
]
# The 2022 file has one more.
BANK_TICKERS_2022 = BANK_TICKERS + ["NASDAQ"]

# Issuer names of 2022 carry the share class; variant -> name used in the other years.
ISSUER_NAMES = {
    "ABC BRASIL  P": "ABC BRASIL",
    "ALFA FINANC O": "ALFA FINANC",
    "ALFA FINANC P": "ALFA FINANC",
    "ALFA HOLDINGO": "ALFA HOLDING",
    "ALFA HOLDINGP": "ALFA HOLDING",
    "ALFA INVEST O": "ALFA INVEST",
    "ALFA INVEST P": "ALFA INVEST",
    "AMAZONIA    O": "AMAZONIA",
    "BANCO BMG   P": "BANCO BMG",
    "BANCO INTER O": "BANCO INTER",
    "BANCO INTER P": "BANCO INTER",
    "BANCO INTER U": "BANCO INTER",
    "BANCO PAN   P": "BANCO PAN",
    "BANESE      O": "BANESE",
    "BANESE      P": "BANESE",
    "BANESTES    O": "BANESTES",
    "BANESTES    P": "BANESTES",
    "BANRISUL    O": "BANRISUL",
    "BR PARTNERS U": "BR PARTNERS",
    "BRADESCO    O": "BRADESCO",
    "BRADESCO    P": "BRADESCO",
    "BRASIL      O": "BRASIL",
    "BRB BANCO   O": "BRB BANCO",
    "BRB BANCO   P": "BRB BANCO",
    "BTGP BANCO  U": "BTGP BANCO",
    "ITAUSA      P": "ITAUSA",
    "ITAUUNIBANCOO": "ITAUUNIBANCO",
    "ITAUUNIBANCOP": "ITAUUNIBANCO",
    "MERC BRASIL O": "MERC BRASIL",
    "MERC BRASIL P": "MERC BRASIL",
    "MERC FINANC P": "MERC FINANC",
    "MODALMAIS   O": "MODALMAIS",
    "MODALMAIS   P": "MODALMAIS",
    "MODALMAIS   U": "MODALMAIS",
    "NORD BRASIL O": "NORD BRASIL",
    "NU-NUBANK   D": "NU-NUBANK",
    "PINE        P": "PINE",
    "SANTANDER BRO": "SANTANDER BR",
    "SANTANDER BRP": "SANTANDER BR",
    "SANTANDER BRU": "SANTANDER BR",
}

# The segments the income-statement analysis leaves out.
EXCLUDED_SEGMENTS = [
    "Sociedade de Crédito Imobiliário - Repassadora",
    "Sociedade de Arrendamento Mercantil",
    "Sociedade Distribuidora de TVM",
    "Sociedade Corretora de TVM",
    "Sociedade Corretora de Câmbio",
    "Companhia Hipotecária",
    "Agência de Fomento",
    "Banco Comercial Estrangeiro - Filial no país",
    "Sociedade de Crédito ao Microempreendedor",
]

# The activities it leaves out, by part of their text and by their whole text.
EXCLUDED_ACTIVITY_PARTS = [
    "Desenvolvimento - exceto BNDES",
    "Desenvolvimento - BNDES",
    "Indústria - Não BNDES",
    "Indústria - BNDES",
]
EXCLUDED_ACTIVITIES = ["Cambio"]
EXCLUDED_NAME_PARTS = ["COOPER"]
INACTIVE = "I"

# Income-statement columns as published (spaces taken out) -> short names.
INCOME_NAMES = {
    "ReceitasdeIntermediaçãoFinanceira\n(a)=(a1)+(a2)+(a3)+(a4)+(a5)+(a6)": "Rec_Interm_Financ_A=A1+A2+A3+A4+A5+A6",
    "RendasdeOperaçõesdeCrédito\n(a1)": "Res_Op_Credito_A1",
    "RendasdeOperaçõesdeArrendamentoMercantil\n(a2)": "Renda_Arrend_Mercantil_A2",
    "RendasdeOperaçõescomTVM\n(a3)": "Rend_Op_TVM_A3",
    "RendasdeOperaçõescomInstrumentosFinanceirosDerivativos\n(a4)": "Rend_Op_Instr_Financ_Derivat_A4",
    "ResultadodeOperaçõesdeCâmbio\n(a5)": "Res_Op_Cambio_A5",
    "RendasdeAplicaçõesCompulsórias\n(a6)": "Rend_Aplc_Compuls_A6",
    "DespesasdeIntermediaçãoFinanceira\n(b)=(b1)+(b2)+(b3)+(b4)+(b5)": "Desp_Interm_Financ_B=B1+B2+B3+B4+B5",
    "DespesasdeCaptação\n(b1)": "Desp_Capta_B1",
    "DespesasdeObrigaçõesporEmpréstimoseRepasses\n(b2)": "Desp_Obrig_Emprest_e_Repasse_B2",
    "DespesasdeOperaçõesdeArrendamentoMercantil\n(b3)": "Desp_Oper_ArrMercantil_B3",
    "ResultadodeOperaçõesdeCâmbio\n(b4)": "Res_Op_Cambio_B4",
    "ResultadodeProvisãoparaCréditosdeDifícilLiquidação\n(b5)": "Res_Prov_Cred_Dif_Liq_B5",
    "ResultadodeIntermediaçãoFinanceira\n(c)=(a)+(b)": "Res_Intermed_Financ_C=A+B",
    "OutrasReceitas/DespesasOperacionais\n(d)=(d1)+(d2)+(d3)+(d4)+(d5)+(d6)+(d7)+(d8)":
        "Outras_Rec_Desp_Op_D=D1+D2+D3+D4+D5+D6+D7+D8",
    "RendasdePrestaçãodeServiços\n(d1)": "Res_Prest_Srv_D1",
    "RendasdeTarifasBancárias\n(d2)": "Renda_Trf_Banc_D2",
    "DespesasdePessoal\n(d3)": "Desp_Pessoal_D3",
    "DespesasAdministrativas\n(d4)": "Desp_Adm_D4",
    "DespesasTributárias\n(d5)": "Desp_Trib_D5",
    "ResultadodeParticipações\n(d6)": "Res_Particpacoes_D6",
    "OutrasReceitasOperacionais\n(d7)": "Outras_Rec_Op_D7",
    "OutrasDespesasOperacionais\n(d8)": "Outras_Desp_Op_D8",
    "ResultadoOperacional\n(e)=(c)+(d)": "Res_Oper_E=C+D",
    "ResultadoNãoOperacional\n(f)": "Res_N_Oper_F",
    "ResultadoantesdaTributação,LucroeParticipação\n(g)=(e)+(f)": "Res_Antes_Trib_Lcr_Partic_G=E+F",
    "ImpostodeRendaeContribuiçãoSocial\n(h)": "ImpRnd_ContrSoc_H",
    "ParticipaçãonosLucros\n(i)": "Partic_Lucros_I",
    "LucroLíquido\n(j)=(g)+(h)+(i)": "Lucro_Lq_J=G+H+I",
    "JurosSobreCapitalPróprio\n(k)": "Jur_Cpt_Proprio_K",
    "JurosSobreCapitalSocialdeCooperativas\n(k)": "Jur_Cap_SocCoop_K",
}
INCOME_DROPPED = ["Jur_Cpt_Proprio_K", "Jur_Cap_SocCoop_K"]
NET_INCOME = "Lucro_Lq_J=G+H+I"

# Branch sheet columns, and the letters they stand under per year.
BRANCH_COLUMNS = [
    "UF", "Total Municípios", "Municípios com agência", "Municípios sem agência com PA",
    "Municípios sem agência sem PA e com PAE", "Municípios sem agência sem PA e sem PAE",
    "Municípios sem agência Total",
]
BRANCH_LETTERS = {
    2018: ["B", "C", "OD", "OE", "OF", "OG", "OH"],
    2019: ["B", "C", "QL", "QM", "QN", "QO", "QP"],
    2020: ["B", "C", "ST", "SU", "SV", "SW", "SX"],
    2021: ["B", "C", "VB", "VC", "VD", "VE", "VF"],
}
BRANCH_SKIP, BRANCH_FOOTER = 8, 7

# The percentage columns of the household-indebtedness table.
INDEBTEDNESS_PERCENTAGES = [
    "inad_cart_cred_tot_porc",
    "inad_cart_cred_pj_tot_porc",
    "inad_cart_cred_pf_tot_porc",
    "comp_renda_fam_jur_div_sfn_rndbf_perc",
    "comp_renda_fam_serv_sfn_rndbf_perc",
    "comp_renda_fam_serv_sfn_exc_cred_hab_rndbf_perc",
    "comp_renda_fam_amort_div_sfn_rndbf_perc",
    "end_fam_sfn_renda_12_mes_perc",
    "end_fam_sfn_exc_cred_hab_rel_renda_acu_12_mes_rndbf_perc",
]
# The same table as published has ten columns, named by place for the relational load.
INDEBTEDNESS_RAW_NAMES = [
    "data",
    "inad_cart_cred_total_%",
    "inad_cart_de_cred_pj_%",
    "inad_cart_cred_pf_%",
    "compr_renda_juros_divida_sfn_com_aj_saz_%",
    "compr_renda_serv_div_sfn_com_aj_saz_%",
    "compr_renda_serv_div_sfn_exceto_cred_habit_com_aj_saz_%",
    "compr_renda_com_amort_div_com_sfn_com_aj_saz_%",
    "endiv_com_sfn_em_rel_renda_acum_ult_doze_meses_%",
    "endiv_sfn_exceto_cred_habit_em_rel_renda_ult_12_meses_%",
]

# The originals, the table each is loaded to, and the rows per insert (None: the target's own), in load order.
LOAD_LIST = [
    ("demonstracao_resultado", "dre_instituicoes_financeiras", None),
    ("resumo_financeiro", "resumo_financeiro_if", None),
    ("listagem_instituicoes", "nomes_if", 1000),
    ("cotacoes_2019", "bolsa_valores_b3", 1000),
    ("cotacoes_2020", "bolsa_valores_2020", 1000),
    ("cotacoes_2021", "bolsa_valores_2021", 1000),
    ("cotacoes_2022", "bolsa_valores_2022", 1000),
    ("pix", "pix", 1000),
    ("ted", "ted", 1000),
    ("cheque", "cheque", 1000),
    ("precatorios_2019", "precatorio2019", 1000),
    ("endividamento_familias", "endiv_familias", 1000),
    ("precatorios_2020", "precatorio2020", 1000),
    ("quadro_agencias", "quadro_agencias", 1000),
    ("agencias_por_banco", "agencias_por_banco", 1000),
    ("terminais_atm", "dist_ATM_por_UF", 1000),
    ("programa_recompensas", "programa_recompensas", 1000),
    ("carteira_credito", "carteira_de_creditos_bancos", 1000),
    ("transacoes_atm", "qtd_transacoes_de_atm_por_canal", 1000),
    ("transacoes_agencias", "qtd_transacoes_de_agencias_por_canal", 1000),
    ("transacoes_central_atendimento", "qtd_transacaoes_de_ca_por_canal", 1000),
    ("transacoes_correspondentes", "qtd_transacoes_de_correspondentes_por_canal", 1000),
    ("transacoes_remotas", "qtd_transacoes_remota_por_canal", 1000),
    ("transacoes_telefone", "qtd_transacoes_de_tele_por_canal", 1000),
    ("pagamentos_transferencias", "qtd_transac__pag_de_conta_e_transf_de_cred", 1000),
    ("cartoes_debito", "emissao_cartao_debitos", 1000),
    ("recompensas", "programas_de_recompesa", 1000),
    ("cartoes_credito", "emissao_cartao_creditos", 1000),
]
