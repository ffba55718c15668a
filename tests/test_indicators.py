import pytest
from bronze import write_text, write_workbook

from aferir.operators.quality import ValidationError
from aferir.plans import indicators
from aferir.schemas import sheets
from aferir.sources.tables import read_years

CPC_2018 = [
    "Ano", "Código da Área", "Área de Avaliação", "Código da IES", "Código do Curso", "Código do Município",
    "Conceito Enade (Contínuo)", "CPC (Contínuo)", "CPC (Faixa)", "Nota Bruta - FG",
    "Nota Padronizada – Regime de Trabalho", "Entidade Beneficiente de Assistência Social (CEBAS)", "Observação", "Extra",
]
CPC_2015 = [
    "Ano", "Código da Área", "Área de enquadramento", "Código da IES", "Código do Município",
    "Nota Contínua do Enade", "CPC Contínuo", "CPC Faixa", "Nota Padronizada de Mestres", "Nota padronizada de mestres",
]
CPC_2007 = ["co_grupo", "Área", "co_ies", "Conceito_Enade", "CPC Contínuo", "codmunic_inep", "Nota Enade"]


@pytest.fixture
def bronze(tmp_path):
    root = tmp_path / "bronze"
    write_workbook(
        root / "cpc" / "2018" / "CPC_2018.xlsx",
        {
            "Atualizações": [["x"]],
            "CPC": [
                CPC_2018,
                [2018, 10, "Direito", 1, 100, 5, 2.5, 3.25, 4, 55.5, 4.5, "X", "o", "e"],
                [None, 10, "Direito", 1, 101, 5, 2.0, 3.0, 3, None, None, "1", None, None],
                [None, 11, "Letras", 2, 200, 6, "SC", None, "SC", None, None, "-", None, None],
                ["Fonte: publicação", None, None, "Nota"],
                [],
            ],
        },
    )
    write_workbook(
        root / "cpc" / "2015" / "cpc2015.xlsx",
        {
            "P": [
                CPC_2015,
                [2015, 10, "Direito", 1, 5, 2.5, 3.25, 4, 9, 1.5],
                [2015, 10, "Direito", 2, 6, 2.5, 3.25, 4, 9, 1.5],
                [2015, 10, "Direito", 3, 7, 2.5, 3.25, 4, 9, 1.5],
                [2015, 10, "Direito", 4, 8, 2.5, 3.25, 4, 9, 1.5],
            ]
        },
    )
    write_workbook(
        root / "cpc" / "2007" / "cpc.xlsx", {"P": [CPC_2007, [10, "Direito", 1, 2.5, 3.25, 5, 1], [10, "D", 2, 2.5, 3.0, 6, 1]]}
    )
    write_workbook(
        root / "conceito-enade" / "2015" / "conceito.xlsx",
        {
            "Legenda": [["x"]],
            "C": [
                ["Código da IES", "Código da Área", "Código do Curso**", "Código do Município***"],
                [1, 10, 1000, 5], [2, 10, 2000, 6], [2, 10, 2001, 6], [9, 10, None, 6],
            ],
        },
    )
    header = "NU_ANO;CO_IES;CO_GRUPO;CO_CURSO;CO_MUNIC_CURSO"
    write_text(
        root / "enade-microdados" / "2015" / "2.DADOS" / "microdados2015_arq1.txt", header,
        "2015;1;10;1111;5", "2015;2;10;2000;6", "2015;2;10;2000;6", "2015;3;10;3000;7", "2015;3;10;3001;9",
        "2015;4;10;4000;8", "2015;4;10;4001;8",
    )
    write_text(
        root / "enade-microdados" / "2007" / "DADOS" / "microdados2007_arq1.txt", "NU_ANO;CO_IES;CO_GRUPO;CO_CURSO",
        "2007;1;10;700", "2007;1;10;700", "2007;2;10;701", "2007;2;10;702",
    )
    return root


def test_cpc_end_to_end(spark, bronze, tmp_path):
    root = str(tmp_path / "data")
    report = indicators.build_cpc(spark, str(bronze), root, [2007, 2015, 2018, 2020, 2022])
    assert report.written == [2007, 2015, 2018]
    assert report.failures == [{"ano_fonte": 2022, "check": "source_file", "violations": 1}]

    silver = {(r.ano, r.co_ies, r.co_curso): r for r in read_years(spark, root, "cpc").collect()}
    first = silver[2018, 1, 100]
    assert (first.nota_bruta_fg, first.nota_pad_regime, first.cpc_faixa, first.in_cebas) == (55.5, 4.5, 4, None)
    assert silver[2018, 1, 101].in_cebas == 1 and silver[2018, 2, 200].enade_continuo is None
    # 2015: 1 from the rating; 2 ambiguous there, then by area; 3 by municipality; 4 stays unknown.
    assert {(k[1], k[2]) for k in silver if k[0] == 2015} == {(1, 1000), (2, 2000), (3, 3000), (4, None)}
    assert {r.nota_pad_mestres for k, r in silver.items() if k[0] == 2015} == {1.5}
    # 2007: year from the folder, no band, course files without municipality.
    assert {(k[1], k[2]) for k in silver if k[0] == 2007} == {(1, 700), (2, None)}

    fact = indicators.fact_cpc(read_years(spark, root, "cpc"))
    got = {(r.ano, r.co_ies, r.co_area): r.co_curso for r in fact.collect()}
    assert got[2018, 1, 10] == 100 and got[2015, 4, 10] == -1 and got[2007, 2, 10] == -1 and len(got) == 8
    assert not {"fonte", "_linha", "ano_fonte"} & set(fact.columns)


def test_cpc_without_course_lookups(spark, tmp_path):
    base = tmp_path / "bronze" / "cpc"
    write_workbook(base / "2007" / "c.xlsx", {"P": [CPC_2007, [10, "D", 1, 2.5, 3.25, 5, 1]]})
    write_workbook(base / "2017" / "c.xlsx", {"P": [["Edição", *CPC_2015[1:]], [2017, 10, "D", 1, 5, 1.0, 1.0, 1, 1, 1]]})
    report = indicators.build_cpc(spark, str(tmp_path / "bronze"), str(tmp_path / "d"), [2007, 2017])
    assert report.written == [2007]
    assert [(f["ano_fonte"], f["check"]) for f in report.failures] == [(2017, "required:co_curso")]


IDD = [
    "Ano", "Código da IES", "Código do Curso", "Área de Avaliação", "Nota Bruta - IDD", "IDD (Contínuo)", "IDD (Faixa)",
    "Observação", "Entidade Beneficiente de Assistência Social (CEBAS)",
]


@pytest.fixture
def graded(spark, tmp_path):
    base = tmp_path / "bronze" / "idd"
    rows = [
        IDD,
        [2021, 1, 1, "A", 1.5, 2.5, 3, None, "X"],
        [None, 1, 2, "A", 1.5, 2.5, "SC", None, "-"],
        [None, 1, 3, "A", 1.5, None, None, "sem conceito", "outro"],
        [None, 1, 4, "A", 1.5, None, None, None, None],
        [None, 1, 5, "A", -4.0, None, 1, None, None],
        [None, 1, 5, "A", 9.0, 9.0, 5, None, None],
        ["Nota:", "texto"],
    ]
    write_workbook(base / "2021" / "IDD_2021.xlsx", {"Plan2": [["x"]], "PLANILHA_IDD": rows})
    write_workbook(
        base / "2016" / "IDD_2016.xlsx",
        {"Plan1": [[*IDD[:3], "Área de Enquadramento", IDD[4], "Nota Padronizada - IDD", IDD[6]], [2016, 1, 1, "A", 1.0, 2.0, 3]]},
    )
    write_workbook(base / "2017" / "IDD.xlsx", {"P": [IDD[:4], [2017, 1, 1, "A"]]})
    report = indicators.build_idd(spark, str(tmp_path / "bronze"), str(tmp_path / "data"), [2016, 2017, 2021])
    return report, read_years(spark, str(tmp_path / "data"), "idd")


def test_idd_end_to_end(spark, graded):
    report, silver = graded
    assert report.written == [2016, 2021]
    assert {f["check"] for f in report.failures if f["ano_fonte"] == 2017} == {
        "required:nota_bruta_idd", "required:idd_continuo", "required:idd_faixa"
    }
    got = {(r.ano, r.co_curso, r["_linha"]): r for r in silver.collect()}
    flag = {k[1]: r for k, r in got.items() if k[0] == 2021 and k[2] < 7}
    assert [flag[c].in_sem_conceito for c in (1, 2, 3, 4, 5)] == [False, True, True, None, False]
    assert [flag[c].idd_continuo for c in (1, 2, 3, 4, 5)] == [2.5, None, None, None, 0.0]
    assert [flag[c].nota_bruta_idd for c in (1, 2, 3, 4)] == [1.5, None, None, 1.5]
    assert [flag[c].in_cebas for c in (1, 2, 3, 4)] == [True, False, None, None]
    assert got[2016, 1, 2].idd_continuo == 2.0 and got[2016, 1, 2].in_cebas is None

    fact = indicators.fact_idd(silver)
    assert "observacao" not in fact.columns and fact.count() == 6
    assert {r.co_curso: r.idd_continuo for r in fact.where("ano = 2021").collect()}[5] == 0.0


def test_fact_idd_from_older_cleaned_tables(spark):
    silver = spark.createDataFrame(
        [(1, 1, 2019, None, "x", "X", 2019, 2), (1, 2, 2019, 3, " ", "-", 2019, 3), (1, 3, 2019, 3, "obs", "?", 2019, 4)],
        "co_ies int, co_curso int, ano int, idd_faixa int, observacao string, in_cebas string, ano_fonte int, _linha int",
    )
    got = {r.co_curso: (r.in_sem_conceito, r.in_cebas) for r in indicators.fact_idd(silver).collect()}
    assert got == {1: (True, True), 2: (False, False), 3: (True, None)}
    bare = silver.drop("in_cebas", "observacao")
    got = {r.co_curso: (r.in_sem_conceito, r.in_cebas) for r in indicators.fact_idd(bare).collect()}
    assert got == {1: (True, None), 2: (False, None), 3: (False, None)}


IGC = [
    "Ano", "Código da IES*", "Nome da IES*", "Sigla da UF", "Organização Acadêmica*", "Categoria Administrativa",
    "Nº de Cursos com CPC no triênio", "Alfa (Proporção de Graduação)", "Beta (Proporção de Mestrado - Equivalente)",
    "Gama (Proporção de Doutorandos – Equivalente)", "Conceito Médio de Graduação", "Conceito Médio de Mestrado",
    "Conceito Médio do doutorado", "IGC (Contínuo)", "IGC (Faixa)", "Entidade Beneficiente de Assistência Social (CEBAS)",
]
IGC_2017 = [
    "Código da IES", "Nome da IES", "UF da IES", "Org. Acadêmica", "Categ. Administrativa",
    "Nº de Cursos com CPC no Triênio", "alfa (Proporção de Graduandos)", "beta (Proporção de Mestrandos - Equivalente)",
    "gama (Proporção de Doutorandos - Equivalente)", "Conceito médio da Graduação", "Conceito Médio do Mestrado",
    "Conceito Médio do doutorado", "IGC (Contínuo)", "IGC (Faixa)",
]


def test_igc_end_to_end(spark, tmp_path):
    base, root = tmp_path / "bronze" / "igc", str(tmp_path / "data")
    tail = ["U", "SP", "Univ", "Pub", 12, 0.5, 0.25, 0.25, 3.5, 4.0, 4.5, 3.75, 4]
    write_workbook(
        base / "2021" / "IGC_2021.xlsx",
        {"Programas_Capes": [["x"]], "IGC": [IGC, [2021, 1, *tail, "Sim"], [None, 2, *tail, "-"], [2021, 3, *tail, "X"], [2021, 1, *tail, "não"]]},
    )
    write_workbook(base / "2017" / "IGC_2017.xlsx", {"IGC": [IGC_2017, [1, *tail]]})
    report = indicators.build_igc(spark, str(tmp_path / "bronze"), root, [2017, 2020, 2021])
    assert (report.written, report.failures) == ([2017, 2021], [])
    fact = indicators.fact_igc(read_years(spark, root, "igc"))
    got = {(r.co_ies, r.ano): r for r in fact.collect()}
    assert {k: r.in_cebas for k, r in got.items()} == {(1, 2021): 1, (2, 2021): 0, (3, 2021): None, (1, 2017): None}
    assert (got[1, 2017].gama, got[1, 2017].igc_faixa, got[1, 2021].gama, got[1, 2021].qt_cursos_cpc) == (0.25, 4, 0.25, 12)


def test_publish_refuses_null_keys(spark, bronze, tmp_path):
    root = str(tmp_path / "data")
    write_workbook(
        bronze / "cpc" / "2018" / "CPC_2018.xlsx", {"P": [CPC_2018, [2018, None, "A", 1, 100, 5, 2.5, 3.25, 4]]}
    )
    assert indicators.build_cpc(spark, str(bronze), root, [2018]).written == [2018]
    with pytest.raises(ValidationError):
        indicators.publish_indicators(spark, root)


def test_score_headers_follow_their_rule():
    headers = sheets.CPC.headers
    assert headers["Nota Bruta - Organização Didático-Pedagógica"] == "nota_bruta_org_didatica"
    assert headers["Nota Padronizada - Oport. Ampliação"] == "nota_pad_oportunidade"
    assert headers["Nota padronizada de regime de trabalho (integral / parcial)"] == "nota_pad_regime"
    assert headers["Nota bruta do IDD"] == "nota_bruta_idd" and headers["Nota IDD"] == "nota_bruta_idd"
    assert headers["Nota Enade Concluintes = Conceito Enade contínuo"] == "enade_continuo"
