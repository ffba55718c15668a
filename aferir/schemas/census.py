"""Higher-education census: institutions and courses."""

from __future__ import annotations

from aferir.schemas.layout import Layout, layout

FIRST_YEAR = 2009

# Institution columns. Names with a leading underscore are kept as published extras.
INSTITUTION = layout(
    """
    ano int = NU_ANO_CENSO
    co_regiao int = CO_REGIAO_IES
    no_regiao = NO_REGIAO_IES
    co_uf int = CO_UF_IES
    sg_uf = SG_UF_IES
    no_uf = NO_UF_IES
    co_municipio bigint = CO_MUNICIPIO_IES
    no_municipio = NO_MUNICIPIO_IES
    in_capital int = IN_CAPITAL_IES
    co_mesorregiao int = CO_MESORREGIAO_IES
    no_mesorregiao = NO_MESORREGIAO_IES
    co_microrregiao int = CO_MICRORREGIAO_IES
    no_microrregiao = NO_MICRORREGIAO_IES
    tp_org_academica int = TP_ORGANIZACAO_ACADEMICA
    tp_rede int = TP_REDE
    tp_categoria_adm int = TP_CATEGORIA_ADMINISTRATIVA
    co_mantenedora bigint = CO_MANTENEDORA
    no_mantenedora = NO_MANTENEDORA
    co_ies bigint = CO_IES
    no_ies = NO_IES
    sg_ies = SG_IES
    _endereco_ies = DS_ENDERECO_IES
    _numero_endereco_ies = DS_NUMERO_ENDERECO_IES
    _complemento_endereco_ies = DS_COMPLEMENTO_ENDERECO_IES
    _bairro_ies = NO_BAIRRO_IES
    _cep_ies = NU_CEP_IES
    _co_local_oferta = CO_LOCAL_OFERTA
    _co_projeto = CO_PROJETO
    _no_local_oferta = NO_LOCAL_OFERTA
    in_comunitaria int = IN_COMUNITARIA
    in_confessional int = IN_CONFESSIONAL
    """,
    required=(
        "co_ies", "ano", "no_ies", "sg_ies", "sg_uf", "co_municipio", "no_municipio",
        "tp_categoria_adm", "tp_org_academica",
    ),
    keys=("co_ies", "ano"),
)

# Staff and library measures of an institution.
_STAFF = """
    ano int = NU_ANO_CENSO
    co_ies bigint = CO_IES
    qt_tec_total bigint = QT_TEC_TOTAL
    qt_tec_fund_incomp_fem bigint = QT_TEC_FUNDAMENTAL_INCOMP_FEM
    qt_tec_fund_incomp_masc bigint = QT_TEC_FUNDAMENTAL_INCOMP_MASC
    qt_tec_fund_comp_fem bigint = QT_TEC_FUNDAMENTAL_COMP_FEM
    qt_tec_fund_comp_masc bigint = QT_TEC_FUNDAMENTAL_COMP_MASC
    qt_tec_medio_fem bigint = QT_TEC_MEDIO_FEM
    qt_tec_medio_masc bigint = QT_TEC_MEDIO_MASC
    qt_tec_superior_fem bigint = QT_TEC_SUPERIOR_FEM
    qt_tec_superior_masc bigint = QT_TEC_SUPERIOR_MASC
    qt_tec_esp_fem bigint = QT_TEC_ESPECIALIZACAO_FEM
    qt_tec_esp_masc bigint = QT_TEC_ESPECIALIZACAO_MASC
    qt_tec_mest_fem bigint = QT_TEC_MESTRADO_FEM
    qt_tec_mest_masc bigint = QT_TEC_MESTRADO_MASC
    qt_tec_dout_fem bigint = QT_TEC_DOUTORADO_FEM
    qt_tec_dout_masc bigint = QT_TEC_DOUTORADO_MASC
    qt_doc_total bigint = QT_DOC_TOTAL; QT_DOCENTE_TOTAL
    qt_doc_exe bigint = QT_DOC_EXE; QT_DOCENTE_EXE
    in_acesso_portal_capes int = IN_ACESSO_PORTAL_CAPES
    in_assina_outra_base int = IN_ASSINA_OUTRA_BASE
    in_acesso_outras_bases int = IN_ACESSO_OUTRAS_BASES
    in_repositorio_inst int = IN_REPOSITORIO_INSTITUCIONAL
    in_busca_integrada int = IN_BUSCA_INTEGRADA
    in_servico_internet int = IN_SERVICO_INTERNET
    in_participa_rede_social int = IN_PARTICIPA_REDE_SOCIAL
    in_catalogo_online int = IN_CATALOGO_ONLINE
    qt_periodico_eletronico bigint = QT_PERIODICO_ELETRONICO
    qt_livro_eletronico bigint = QT_LIVRO_ELETRONICO
"""

# Breakdowns of active teachers. Published as QT_DOC_EX_<x>, in 2009 as DOC_EX_<x>;
# canonical qt_doc_exe_<x>.
_TEACHERS = """
    FEMI MASC SEM_GRAD GRAD ESP MEST DOUT INT INT_DE INT_SEM_DE PARC HOR
    0_29 30_34 35_39 40_44 45_49 50_54 55_59 60_MAIS
    BRANCA PRETA PARDA AMARELA INDIGENA COR_ND BRA EST COM_DEFICIENCIA
""".split()


def _teacher_column(name: str) -> str:
    return "qt_doc_exe_" + ("fem" if name == "FEMI" else name.lower())


STAFF: Layout = layout(
    _STAFF,
    types={_teacher_column(name): "bigint" for name in _TEACHERS},
    extra=[
        (prefix + name, _teacher_column(name))
        for name in _TEACHERS
        for prefix in ("QT_DOC_EX_", "DOC_EX_")
    ],
    required=("co_ies", "ano"),
    keys=("co_ies", "ano"),
)

# Course columns whose canonical name is the published name in lower case.
_COURSE_TEXT = """
    NO_CURSO CO_CINE_ROTULO NO_CINE_ROTULO CO_CINE_AREA_GERAL NO_CINE_AREA_GERAL
    CO_CINE_AREA_ESPECIFICA NO_CINE_AREA_ESPECIFICA CO_CINE_AREA_DETALHADA NO_CINE_AREA_DETALHADA
    NO_REGIAO SG_UF NO_UF NO_MUNICIPIO
""".split()
_COURSE_LONG = "CO_IES CO_CURSO CO_MUNICIPIO".split()
_COURSE_INT = """
    TP_GRAU_ACADEMICO TP_MODALIDADE_ENSINO TP_NIVEL_ACADEMICO IN_GRATUITO TP_REDE CO_REGIAO CO_UF
    IN_CAPITAL TP_DIMENSAO QT_VG_TOTAL
    QT_ING QT_ING_FEM QT_ING_MASC QT_ING_BRANCA QT_ING_PRETA QT_ING_PARDA QT_ING_AMARELA
    QT_ING_INDIGENA QT_ING_CORND QT_ING_RESERVA_VAGA QT_ING_ENEM
    QT_MAT QT_MAT_FEM QT_MAT_MASC QT_MAT_BRANCA QT_MAT_PRETA QT_MAT_PARDA QT_MAT_AMARELA
    QT_MAT_INDIGENA QT_MAT_CORND
    QT_CONC QT_CONC_FEM QT_CONC_MASC QT_CONC_BRANCA QT_CONC_PRETA QT_CONC_PARDA QT_CONC_AMARELA
    QT_CONC_INDIGENA QT_CONC_CORND
    QT_ING_FINANC QT_ING_FIES QT_MAT_FINANC QT_MAT_FIES QT_CONC_FINANC
    QT_MAT_APOIO_SOCIAL QT_MAT_MOB_ACADEMICA QT_ALUNO_DEFICIENTE QT_MAT_DEFICIENTE
""".split()

# Course columns that are renamed.
_COURSE_RENAMED = """
    ano int = NU_ANO_CENSO
    tp_org_academica int = TP_ORGANIZACAO_ACADEMICA
    tp_categoria_adm int = TP_CATEGORIA_ADMINISTRATIVA
    qt_ing_esc_publica int = QT_ING_PROCESCPUBLICA
    qt_ing_esc_privada int = QT_ING_PROCESCPRIVADA
    qt_ing_esc_nd int = QT_ING_PROCNAOINFORMADA
    qt_ing_prouni_int int = QT_ING_PROUNII
    qt_ing_prouni_parc int = QT_ING_PROUNIP
    qt_mat_prouni_int int = QT_MAT_PROUNII
    qt_mat_prouni_parc int = QT_MAT_PROUNIP
"""

COURSE: Layout = layout(
    _COURSE_RENAMED,
    types={
        **{h.lower(): "string" for h in _COURSE_TEXT},
        **{h.lower(): "bigint" for h in _COURSE_LONG},
        **{h.lower(): "int" for h in _COURSE_INT},
    },
    extra=[(h, h.lower()) for h in (*_COURSE_LONG, *_COURSE_TEXT, *_COURSE_INT)],
    required=(
        "ano", "co_ies", "co_curso", "no_curso", "tp_grau_academico", "tp_modalidade_ensino",
        "sg_uf", "qt_mat", "qt_ing", "qt_conc",
    ),
    keys=("co_ies", "co_curso", "ano"),
)

# Labels of the type codes.
ORGANISATION_LABELS = {
    1: "Universidade",
    2: "Centro Universitário",
    3: "Faculdade",
    4: "Instituto Federal de Educação, Ciência e Tecnologia",
    5: "Centro Federal de Educação Tecnológica",
}
NETWORK_LABELS = {1: "Pública", 2: "Privada"}
CATEGORY_LABELS = {
    1: "Pública Federal",
    2: "Pública Estadual",
    3: "Pública Municipal",
    4: "Privada com fins lucrativos",
    5: "Privada sem fins lucrativos",
    6: "Privada - Particular em sentido estrito",
    7: "Especial",
    8: "Privada comunitária",
    9: "Privada confessional",
}
