import os
import time

import pytest
from bronze import write_text
from core_helpers import rows

from aferir.operators.quality import ValidationError
from aferir.plans import census
from aferir.sources.tables import read_table, read_years

HEADER = (
    "NU_ANO_CENSO;CO_IES;NO_IES;SG_IES;SG_UF_IES;CO_MUNICIPIO_IES;NO_MUNICIPIO_IES;"
    "TP_CATEGORIA_ADMINISTRATIVA;TP_ORGANIZACAO_ACADEMICA;DS_ENDERECO_IES;QT_TEC_TOTAL;"
)


@pytest.fixture
def bronze(tmp_path):
    root = tmp_path / "bronze"
    base = root / "censo-superior"
    write_text(
        base / "2009" / "dados" / "MICRODADOS_IES_2009.CSV", HEADER + "QT_DOCENTE_TOTAL;DOC_EX_FEMI;UNKNOWN",
        "2009;1;Universidade São João;USJ;SP;355;São Paulo;1;1;Rua A;10;20;7;x",
        "2009;2;Faculdade B;NA;RJ;330;Rio;;9;N/A;nan;5;;x",
        "2009;1;Segunda;DUP;SP;355;São Paulo;4;1;Rua B;11;21;8;x",
    )
    write_text(
        base / "2023" / "MICRODADOS_ED_SUP_IES_2023.CSV", HEADER + "QT_DOC_TOTAL;TP_REDE;IN_COMUNITARIA",
        "2023;1;Universidade Nova;UN;SP;355;São Paulo;4;2;Rua A;12;25;1;0",
        "2023;3;Faculdade C;FC;MG;310;Belo Horizonte;5;3;;1;2;;1",
    )
    return root


def test_institutions_end_to_end(spark, bronze, tmp_path):
    root = str(tmp_path / "data")
    state, staff = census.build_institutions(spark, str(bronze), root, [2009, 2023])
    assert (state.written, state.failures, staff.written) == ([2009, 2023], [], [2009, 2023])

    silver = read_years(spark, root, "censo_ies")
    types = dict(silver.dtypes)
    assert (types["ano"], types["co_ies"], types["no_ies"], types["_endereco_ies"]) == ("int", "bigint", "string", "string")
    network = {(r.ano, r.co_ies, r.no_ies): r.tp_rede for r in silver.collect()}
    # Derived in 2009 (null category is private), as published in 2023 (also when null).
    assert network[2009, 1, "Universidade São João"] == 1 and network[2009, 2, "Faculdade B"] == 2
    assert network[2023, 1, "Universidade Nova"] == 1 and network[2023, 3, "Faculdade C"] is None
    assert read_years(spark, root, "censo_ies", [2023]).count() == 2

    gold = census.publish_institutions(spark, root)
    hist = {(r.co_ies, r.ano): r for r in gold["hist_ies"].collect()}
    assert set(hist) == {(1, 2009), (1, 2023), (2, 2009), (3, 2023)}
    assert hist[1, 2009].no_ies == "Universidade São João" and hist[1, 2009].categoria_adm == "Pública Federal"
    assert hist[2, 2009].categoria_adm is None and hist[2, 2009].org_academica is None and hist[2, 2009].rede == "Privada"
    assert gold["hist_ies"].columns == list(census.HISTORY)

    dim = {r.co_ies: r for r in gold["dim_ies"].collect()}
    assert {k: v.ano_referencia for k, v in dim.items()} == {1: 2023, 2: 2009, 3: 2023}
    assert (dim[1].no_ies_atual, dim[1].org_academica_atual, dim[1].sg_uf) == ("Universidade Nova", "Centro Universitário", "SP")

    fact = {(r.co_ies, r.ano): r for r in gold["fact_censo_ies"].collect()}
    assert (fact[1, 2009].qt_doc_total, fact[1, 2009].qt_doc_exe_fem, fact[1, 2023].qt_doc_total) == (20, 7, 25)
    assert fact[2, 2009].qt_tec_total is None and len(fact) == 4


def test_refresh_skips_unchanged_years(spark, bronze, tmp_path):
    root = str(tmp_path / "data")
    census.build_institutions(spark, str(bronze), root, [2009, 2023])
    state, _ = census.build_institutions(spark, str(bronze), root, [2009, 2023])
    assert (state.written, state.unchanged) == ([], [2009, 2023])
    changed = next((bronze / "censo-superior" / "2023").glob("*.CSV"))
    later = time.time() + 60
    os.utime(changed, (later, later))
    state, _ = census.build_institutions(spark, str(bronze), root, [2009, 2023])
    assert (state.written, state.unchanged) == ([2023], [2009])
    state, _ = census.build_institutions(spark, str(bronze), root, [2009, 2023], force=True)
    assert state.written == [2009, 2023]


def test_a_bad_year_does_not_stop_the_others(spark, bronze, tmp_path):
    root = str(tmp_path / "data")
    write_text(
        bronze / "censo-superior" / "2010" / "IES_2010.CSV", HEADER + "QT_DOC_TOTAL",
        "2010;1;U;U;SP;355;São Paulo;one;1;;3;4",
    )
    write_text(bronze / "censo-superior" / "2011" / "IES_2011.CSV", "NU_ANO_CENSO;CO_IES", "2011;", "2011;5")
    state, staff = census.build_institutions(spark, str(bronze), root, [2009, 2010, 2011, 2012])
    assert state.written == [2009]
    failed = {(f["ano_fonte"], f["check"]) for f in state.failures}
    assert (2010, "cast:tp_categoria_adm:int") in failed and (2011, "no_nulls:co_ies") in failed
    assert (2011, "required:no_ies") in failed and (2012, "source_file") in failed
    assert staff.written == [2009, 2010]
    with pytest.raises(ValueError):
        census.build_institutions(spark, str(bronze), root, [2008])


COURSE_HEADER = (
    "NU_ANO_CENSO;CO_IES;CO_CURSO;NO_CURSO;CO_CINE_ROTULO;TP_GRAU_ACADEMICO;TP_MODALIDADE_ENSINO;SG_UF;"
    "QT_MAT;QT_ING;QT_CONC;QT_ING_PROCESCPUBLICA"
)


def test_courses_end_to_end(spark, tmp_path):
    base, root = tmp_path / "bronze" / "censo-superior", str(tmp_path / "data")
    write_text(
        base / "2022" / "CADASTRO_CURSOS_2022.CSV", COURSE_HEADER,
        "2022;1;100;Direito;0421D01;1;1;SP;50;10;5;3", "2022;1;100;Direito II;0421D01;1;1;SP;60;10;5;3",
        "2022;1;101;Letras;0231L01;2;2;SP;;;;",
    )
    write_text(base / "2021" / "cursos_2021.csv", COURSE_HEADER, "2021;1;100;Direito;0421;1;1;SP;many;1;1;1")
    report = census.build_courses(spark, str(tmp_path / "bronze"), root, [2021, 2022])
    assert report.written == [2022]
    assert report.failures == [{"ano_fonte": 2021, "check": "cast:qt_mat:int", "violations": 1}]
    fact = census.publish_courses(spark, root)
    got = {r.co_curso: r for r in fact.collect()}
    assert (got[100].no_curso, got[100].qt_mat, got[100].co_cine_rotulo, got[100].qt_ing_esc_publica) == ("Direito", 50, "0421D01", 3)
    assert got[101].qt_mat is None and "_linha" not in fact.columns and "ano_fonte" not in fact.columns


def test_gold_gate_keeps_the_published_table(spark, tmp_path):
    from aferir.plans.build import publish_gold

    path = str(tmp_path / "t")
    publish_gold(spark.range(3).toDF("k"), path, ["k"], ["k"])
    with pytest.raises(ValidationError):
        publish_gold(spark.createDataFrame([(1,), (1,)], "k bigint"), path, ["k"], ["k"])
    with pytest.raises(ValidationError):
        publish_gold(spark.createDataFrame([(None,)], "k bigint"), path, ["k"], ["k"])
    assert rows(read_table(spark, path)) == [{"k": 0}, {"k": 1}, {"k": 2}]


def test_each_file_is_parsed_once(spark, bronze, tmp_path, monkeypatch):
    """Rows that the parser hands out while both tables are gated and written: as many as the files hold."""
    from pyspark.sql import functions as F

    from aferir.sources import delimited

    parsed, read = spark.sparkContext.accumulator(0), delimited._read

    def counting(*args):
        def count(x):
            parsed.add(1)
            return x

        df = read(*args)
        return df.withColumn(df.columns[0], F.udf(count)(df.columns[0]))

    monkeypatch.setattr(delimited, "_read", counting)
    state, staff = census.build_institutions(spark, str(bronze), str(tmp_path / "data"), [2009, 2023])
    assert state.written == staff.written == [2009, 2023]
    assert parsed.value == 5


def test_one_table_missing_rebuilds_both(spark, bronze, tmp_path):
    import shutil

    root = str(tmp_path / "data")
    census.build_institutions(spark, str(bronze), root, [2009, 2023])
    shutil.rmtree(tmp_path / "data" / "silver" / "censo_fact" / "ano_fonte=2023")
    state, staff = census.build_institutions(spark, str(bronze), root, [2009, 2023])
    assert state.written == staff.written == [2023] and state.unchanged == staff.unchanged == [2009]
