"""The integrity report over tables built from raw files, passing and failing."""

from bronze import write_text, write_workbook
from pyspark.sql import functions as F
from test_enade import ARQ1, ARQ3, student

from aferir.plans import census, enade, indicators, integrity
from aferir.sinks.refresh import write_gold
from aferir.sources.tables import gold_path, read_table

CENSUS = (
    "NU_ANO_CENSO;CO_IES;NO_IES;SG_IES;SG_UF_IES;CO_MUNICIPIO_IES;NO_MUNICIPIO_IES;"
    "TP_CATEGORIA_ADMINISTRATIVA;TP_ORGANIZACAO_ACADEMICA;QT_DOC_TOTAL"
)
CPC = [
    "Ano", "Código da Área", "Área de Avaliação", "Código da IES", "Código do Curso", "Conceito Enade (Contínuo)",
    "CPC (Contínuo)", "CPC (Faixa)", "Nota Bruta - FG",
]


def build(spark, tmp_path, raw_score):
    bronze, root = tmp_path / "bronze", str(tmp_path / "data")
    write_text(
        bronze / "censo-superior" / "2018" / "IES_2018.CSV", CENSUS,
        "2018;1;U;U;SP;355;S;1;1;9", "2018;2;F;F;SP;355;S;4;3;9",
    )
    data = bronze / "enade-microdados" / "2018" / "DADOS"
    write_text(data / "microdados2018_arq1.txt", ARQ1 + "CO_REGIAO_CURSO", "2018;100;1;4;2;10;1;355;35;3", "2018;101;2;4;2;10;1;355;35;3")
    write_text(data / "microdados2018_arq3.txt", ARQ3, student(2018, 100, 555, 40), student(2018, 101, 555, 60), student(2018, 101, 222, ""))
    write_text(data / "microdados2018_arq7.txt", "NU_ANO;CO_CURSO;QE_I01", "2018;100;A", "2018;100;B")
    write_workbook(
        bronze / "cpc" / "2018" / "cpc.xlsx",
        {"P": [CPC, [2018, 10, "A", 1, 100, 2.5, 3.0, 3, raw_score], [2018, 10, "A", 2, 101, 2.5, 3.0, 3, 60.1]]},
    )
    census.build_institutions(spark, str(bronze), root, [2018])
    census.publish_institutions(spark, root)
    enade.build_students(spark, str(bronze), root, [2018])
    enade.publish_scores(spark, root)
    enade.publish_profiles(spark, str(bronze), root, [2018])
    indicators.build_cpc(spark, str(bronze), root, [2018])
    fact = indicators.fact_cpc(integrity.read_years(spark, root, "cpc"))
    write_gold(fact, gold_path(root, "fact_cpc"), ["co_ies", "ano", "co_area"])
    return str(bronze), root


def test_report_passes_then_fails(spark, tmp_path):
    bronze, root = build(spark, tmp_path, 40.2)
    report = {(r.tabela, r.check): r for r in integrity.integrity_report(spark, root, [2018]).collect()}
    assert {k for k, r in report.items() if not r.ok} == set()
    assert {t for t, c in report if c == "pk"} == {
        "fact_enade", "fact_cpc", "fact_censo_ies", "dim_ies", "hist_ies"
    }
    assert ("fact_enade_perfil", "in_range:qe_i01_A") in report and report["fact_enade", "cpc"].valor < 0.3

    summary = {r.tabela: r for r in integrity.gold_summary(spark, root).collect()}
    assert (summary["fact_cpc"].linhas, summary["fact_cpc"].cursos, summary["fact_cpc"].sem_curso) == (2, 2, 0)
    assert summary["dim_ies"].ies == 2 and summary["fact_enade"].anos == "2018"

    drift = integrity.header_profile(spark, bronze, "cpc", [2018]).collect()
    assert {r.coluna for r in drift} == set(CPC) and {r.anos for r in drift} == {"2018"}

    # Another year expected, institution 2 unknown, and a score far from CPC.
    for table, change in (
        ("dim_ies", lambda d: d.where("co_ies = 1")),
        ("fact_cpc", lambda d: d.withColumn("nota_bruta_fg", F.col("nota_bruta_fg") + 5)),
    ):
        before = read_table(spark, gold_path(root, table))
        changed = change(spark.createDataFrame(before.collect(), before.schema))
        write_gold(changed, gold_path(root, table), ["co_ies"])
    report = {(r.tabela, r.check): r.ok for r in integrity.integrity_report(spark, root, [2018, 2019]).collect()}
    assert {k for k, ok in report.items() if not ok} == {
        ("fact_enade", "fk:dim_ies"), ("fact_enade", "cpc"), ("fact_enade", "anos"), ("enade_microdados", "anos")
    }
