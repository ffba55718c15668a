"""Indicator workbooks: CPC, IDD, IGC and the rating sheet with course codes.

Headers are compared folded (case, accents, footnote asterisks, dashes and blanks do not count), so
one spelling stands for all of its yearly variants. Headers that are not listed are not published.
"""

from __future__ import annotations

from aferir.schemas.layout import Layout, layout

# Sheets that hold no data rows.
SIDE_SHEETS = ("Atualizações", "Plan2", "Plan3")
RATING_SIDE_SHEETS = (*SIDE_SHEETS, "Legenda", "Notas")
IGC_SIDE_SHEETS = (
    "Atualizações", "Atualização",
    "CPC_2016_2017_2018", "CPC_2017_2018_2019", "CPC_2018_2019_2021",
    "Programas_Capes", "Programas_Capes_2018", "Programas_CAPES", "Programas CAPES",
    "matrículas_2019_2021_2022", "matriculas_2021_2022_2023", "matrículas_2021_2022_2023",
)

# Score headers as published.
_SCORE_HEADERS = [
    ("Nota Bruta - FG", "nota_bruta_fg"),
    ("Nota bruta de formação geral", "nota_bruta_fg"),
    ("Nota Bruta - CE", "nota_bruta_ce"),
    ("Nota bruta de componente específico", "nota_bruta_ce"),
    ("Nota Padronizada - FG", "nota_pad_fg"),
    ("Nota padronizada de formação geral", "nota_pad_fg"),
    ("Nota Padronizada - CE", "nota_pad_ce"),
    ("Nota padronizada de componente específico", "nota_pad_ce"),
    ("Nota Bruta - IDD", "nota_bruta_idd"),
    ("Nota bruta do IDD", "nota_bruta_idd"),
    ("Nota Padronizada - IDD", "nota_pad_idd"),
    ("Nota padronizada do IDD", "nota_pad_idd"),
    ("Nota Bruta - Mestres", "nota_bruta_mestres"),
    ("Nota Padronizada - Mestres", "nota_pad_mestres"),
    ("Nota padronizada de mestres", "nota_pad_mestres"),
    ("Nota Bruta - Doutores", "nota_bruta_doutores"),
    ("Nota Padronizada - Doutores", "nota_pad_doutores"),
    ("Nota padronizada de doutores", "nota_pad_doutores"),
    ("Nota Bruta - Regime de Trabalho", "nota_bruta_regime"),
    ("Nota Padronizada - Regime de Trabalho", "nota_pad_regime"),
    ("Nota padronizada de regime de trabalho (integral / parcial)", "nota_pad_regime"),
    ("Nota padronizada de regime de trabalho", "nota_pad_regime"),
    ("Nota Bruta - Organização Didático-Pedagógica", "nota_bruta_org_didatica"),
    ("Nota Bruta - Org. Didático-Pedagógica", "nota_bruta_org_didatica"),
    ("Nota Padronizada - Organização Didático-Pedagógica", "nota_pad_org_didatica"),
    ("Nota padronizada de organização didático pedagógica", "nota_pad_org_didatica"),
    ("Nota Padronizada - Org. Didático-Pedagógica", "nota_pad_org_didatica"),
    ("Nota Bruta - Infraestrutura e Instalações Físicas", "nota_bruta_infra"),
    ("Nota Bruta - Infraestrutura", "nota_bruta_infra"),
    ("Nota Padronizada - Infraestrutura e Instalações Físicas", "nota_pad_infra"),
    ("Nota padronizada de infraestrutura", "nota_pad_infra"),
    ("Nota Padronizada - Infraestrutura", "nota_pad_infra"),
    ("Nota Bruta - Oportunidade de Ampliação da Formação", "nota_bruta_oportunidade"),
    ("Nota Bruta - Oportunidades de Ampliação da Formação", "nota_bruta_oportunidade"),
    ("Nota Bruta - Oport. Ampliação", "nota_bruta_oportunidade"),
    ("Nota Padronizada - Oportunidade de Ampliação da Formação", "nota_pad_oportunidade"),
    ("Nota Padronizada - Oportunidades de Ampliação da Formação", "nota_pad_oportunidade"),
    ("Nota Padronizada - Oport. Ampliação", "nota_pad_oportunidade"),
]

CPC: Layout = layout(
    """
    ano int = Ano; Ano Enade; Edição
    co_area bigint = Código da Área; Cód.Área; co_grupo; Código Área
    area_avaliacao = Área de Avaliação; Área de Enquadramento; Área; Área Enquadramento
    grau_academico = Grau acadêmico
    modalidade = Modalidade de Ensino
    co_ies bigint = Código da IES; co_ies; Código IES; Cód.IES
    no_ies = Nome da IES; IES
    sg_ies = Sigla da IES; Sigla; Sigla IES
    org_academica = Organização Acadêmica; Organização; Org. Acadêmica
    categoria_adm = Categoria Administrativa; Dep. Administrativa; Categ. Administrativa
    co_curso bigint = Código do Curso
    co_municipio bigint = Código do Município; Código do município do curso; Cód. Município; codmunic_inep; Código Município
    no_municipio = Município do Curso; Município (funcionamento do curso); Município
    sg_uf = Sigla da UF; UF do curso; UF; Sigla UF
    qt_inscritos int = Nº de Concluintes Inscritos; Número concluintes inscritos no Enade; Conluintes Inscritos; Concluintes Inscritos; n. alunos presentes Enade; Número Concluintes Inscritos; Número de Concluintes Inscritos
    qt_participantes int = Nº de Concluintes Participantes; Número concluintes participantes no Enade; Concluintes Participantes; Participantes Concluintes; Número de Participantes Concluintes; Número de Concluintes Participantes
    qt_participantes_idd int = Concluintes participantes com nota no Enem; Nº de Concluintes Participantes com nota no Enem; Número de ingressantes participantes no Enem; Ingressantes participantes no Enem
    prop_participantes_idd double = Proporção de concluintes participantes com nota no Enem; Percentual de Concluintes participantes com nota no Enem
    nota_bruta_idd double = Nota IDD
    nota_pad_mestres double = Nota Mestrado; Nota_mestre
    nota_pad_doutores double = Nota Doutorado; Nota_doutor
    nota_pad_regime double = Nota Regime; Nota_regime
    nota_pad_org_didatica double = Nota de Organização Pedagógica; Nota_pedag
    nota_pad_infra double = Nota de Infraestrutura; Nota_infra
    enade_continuo double = Conceito Enade (Contínuo); Nota Contínua do Enade; Nota Enade Concluintes = Conceito Enade contínuo; Nota de concluintes; Nota Enade Concluintes; Conceito_Enade
    cpc_continuo double = CPC (Contínuo); CPC Contínuo
    cpc_faixa int = CPC (Faixa); CPC Faixa
    in_cebas int = Entidade Beneficiente de Assistência Social (CEBAS)
    """,
    types={target: "double" for _, target in _SCORE_HEADERS},
    extra=_SCORE_HEADERS,
    required=("ano", "co_ies", "area_avaliacao", "enade_continuo", "cpc_continuo", "cpc_faixa", "co_curso"),
    keys=("co_ies", "ano"),
    # 2013 repeats these two scores under a title that differs from a mapped one only by case.
    ignored=frozenset({"Nota Padronizada de Mestres", "Nota Padronizada de Doutores"}),
)
# Years in which a required column was not published.
CPC_NOT_PUBLISHED = {"co_curso": range(2007, 2017), "cpc_faixa": (2007, 2008)}
YEARS_WITHOUT_COURSE = tuple(range(2007, 2017))
YEARS_WITH_RATED_COURSE = (2015, 2016)

IDD: Layout = layout(
    """
    ano int = Ano
    co_area bigint = Código da Área
    area_avaliacao = Área de Avaliação; Área de Enquadramento
    grau_academico = Grau Acadêmico
    co_ies bigint = Código da IES; co_ies
    no_ies = Nome da IES
    sg_ies = Sigla da IES
    org_academica = Organização Acadêmica
    categoria_adm = Categoria Administrativa
    co_curso bigint = Código do Curso
    modalidade = Modalidade de Ensino
    co_municipio bigint = Código do Município
    no_municipio = Município do Curso
    sg_uf = Sigla da UF
    qt_inscritos int = Nº de Concluintes Inscritos; Concluintes Inscritos
    qt_participantes int = Nº de Concluintes Participantes; Concluintes Participantes
    qt_participantes_idd int = Nº de Concluintes Participantes com nota no Enem; Concluintes Participantes com nota no Enem
    prop_participantes_idd double = Proporção de Concluintes participantes com nota no Enem; Percentual de Concluintes participantes com nota no Enem
    nota_bruta_idd double = Nota Bruta - IDD
    idd_continuo double = Nota Padronizada - IDD; IDD (Contínuo)
    idd_faixa int = IDD (Faixa)
    observacao = Observação
    in_cebas boolean = Entidade Beneficiente de Assistência Social (CEBAS)
    """,
    types={"in_sem_conceito": "boolean"},
    required=("ano", "co_ies", "co_curso", "area_avaliacao", "nota_bruta_idd", "idd_continuo", "idd_faixa"),
    keys=("co_ies", "co_curso", "ano"),
)

IGC: Layout = layout(
    """
    ano int = Ano
    co_ies bigint = Código da IES
    no_ies = Nome da IES
    sg_ies = Sigla da IES
    org_academica = Organização Acadêmica; Org. Acadêmica
    categoria_adm = Categoria Administrativa; Categ. Administrativa
    sg_uf = Sigla da UF; UF da IES
    qt_cursos_cpc int = Nº de Cursos com CPC no triênio
    alfa double = Alfa (Proporção de Graduação); alfa (Proporção de Graduandos)
    beta double = Beta (Proporção de Mestrado - Equivalente); beta (Proporção de Mestrandos - Equivalente)
    gama double = Gama (Proporção de Doutorandos - Equivalente)
    conceito_graduacao double = Conceito Médio de Graduação; Conceito médio da Graduação
    conceito_mestrado double = Conceito Médio de Mestrado; Conceito Médio do Mestrado
    conceito_doutorado double = Conceito Médio do doutorado
    igc_continuo double = IGC (Contínuo)
    igc_faixa int = IGC (Faixa)
    in_cebas int = Entidade Beneficiente de Assistência Social (CEBAS)
    """,
    required=(
        "co_ies", "no_ies", "sg_uf", "org_academica", "categoria_adm", "qt_cursos_cpc", "alfa",
        "conceito_graduacao", "beta", "conceito_mestrado", "conceito_doutorado", "igc_continuo",
        "igc_faixa",
    ),
    keys=("co_ies", "ano"),
)

RATING: Layout = layout(
    """
    co_ies bigint = Código da IES; Código IES; co_ies
    co_curso bigint = Código do Curso
    co_area bigint = Código da Área; Código Área; Cód.Área
    co_municipio bigint = Código do Município; Cód. Município
    """
)
