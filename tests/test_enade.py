import pytest
from bronze import write_text
from core_helpers import rows
from pyspark.sql import functions as F

from aferir.operators import quality
from aferir.plans import enade
from aferir.sources.tables import read_years

ARQ1 = "NU_ANO;CO_CURSO;CO_IES;CO_CATEGAD;CO_ORGACAD;CO_GRUPO;CO_MODALIDADE;CO_MUNIC_CURSO;CO_UF_CURSO;"
ARQ3 = "NU_ANO;CO_CURSO;TP_PRES;NT_GER;NT_FG;NT_CE;NT_OBJ_FG;NT_OBJ_CE;NT_DIS_FG;NT_DIS_CE;DS_VT_ACE_OFG;CO_RS_I1"


def student(year, course, present, score, vector="000090900"):
    return f"{year};{course};{present};{score};{score};{score};1;2;3;4;{vector};A"


@pytest.fixture
def bronze(tmp_path):
    root = tmp_path / "bronze"
    data = root / "enade-microdados"
    first = data / "2018" / "2018" / "2. DADOS"
    write_text(
        first / "microdados2018_arq1.txt", ARQ1 + "CO_REGIÃO_CURSO",
        *["2018;100;1;4;2;10;1;355;35;3"] * 3, *["2018;101;1;4;2;10;1;355;35;3"] * 2, "2018;102;2;4;2;10;1;355;35;3",
        "2018;103;2;4;2;11;1;355;35;3",
    )
    write_text(
        first / "microdados2018_arq3.txt", ARQ3,
        student(2018, 100, 555, 40), student(2018, 100, 555, 50.5), student(2018, 100, 222, ""),
        student(2018, 101, 555, 60), student(2018, 101, 555, "45,3"),
        student(2018, 102, 222, ""), student(2018, 103, 555, 10), student(2018, "DJ1", 555, 99),
    )
    second = data / "2019" / "DADOS"
    write_text(second / "microdados2019_arq1.txt", ARQ1 + "CO_REGIAO_CURSO", "2019;100;9;4;2;10;1;355;35;3")
    write_text(second / "microdados2019_arq3.txt", ARQ3, student(2019, 100, 555, 70, "9" * 40))

    # Questionnaire: question 1 in file 7, question 2 in file 8; 2019 has another column order.
    write_text(
        first / "microdados2018_arq7.txt", "NU_ANO;CO_CURSO;QE_I01", "2018;100;A", "2018;100;A", '2018;100;"B"',
        "2018;100;", "2018;101;B", "2018;DJ1;A", "2018;103;NA",
    )
    write_text(first / "microdados2018_arq8.txt", "NU_ANO;CO_CURSO;QE_I02", "2018;101;A")
    write_text(second / "microdados2019_arq7.txt", 'NU_ANO;"QE_I01";"CO_CURSO"', "2019;C;100")
    write_text(second / "microdados2019_arq9.txt", "NU_ANO;CO_CURSO;OTHER", "2019;100;Z")
    return root


@pytest.fixture
def silver(spark, bronze, tmp_path):
    root = str(tmp_path / "data")
    report = enade.build_students(spark, str(bronze), root, [2018, 2019, 2020])
    assert (report.written, report.failures) == ([2018, 2019], [])
    return read_years(spark, root, "enade_microdados")


def test_students(spark, silver):
    types = dict(silver.dtypes)
    assert (types["nt_ger"], types["vt_ace_ofg"], types["co_regiao"], types["co_rs_i1"]) == ("float", "string", "int", "string")
    # One row per student of a known course; the same course code belongs to another institution in 2019.
    assert silver.groupBy("ano").count().orderBy("ano").collect() == [(2018, 7), (2019, 1)]
    assert {(r.ano, r.co_curso, r.co_ies) for r in silver.collect()} >= {(2018, 100, 1), (2019, 100, 9)}
    assert {r.vt_ace_ofg for r in silver.collect()} == {"000090900", "9" * 40}
    assert silver.where("co_curso = 101 AND nt_ger IS NULL").count() == 1


def test_course_scores(spark, silver):
    got = {(r.co_curso, r.ano): r for r in enade.course_scores(silver).collect()}
    assert len(got) == 5
    one = got[100, 2018]
    assert (one.co_ies, one.qt_inscritos, one.qt_presentes, one.co_grupo, one.co_regiao) == (1, 3, 2, 10, 3)
    assert one.tx_participacao == pytest.approx(2 / 3, abs=1e-6)
    assert one.nt_ger_media == pytest.approx(45.25) and one.nt_ger_mediana == pytest.approx(45.25)
    assert one.nt_ger_dp == pytest.approx(7.424621, abs=1e-4) and one.nt_obj_ce_media == 2.0
    assert (one.percentil_grupo, got[101, 2018].percentil_grupo) == (0.0, 100.0)
    # No present student: no scores, no position; alone in the area: 50.
    absent = got[102, 2018]
    assert (absent.qt_presentes, absent.nt_ger_media, absent.tx_participacao, absent.percentil_grupo) == (0, None, 0.0, None)
    assert got[103, 2018].percentil_grupo == 50.0 and got[103, 2018].nt_ger_dp is None


def test_published_scores_pass_the_integrity_checks(spark, silver, tmp_path):
    fact = enade.publish_scores(spark, str(tmp_path / "data"))
    assert dict(fact.dtypes)["qt_presentes"] == "int" and dict(fact.dtypes)["percentil_grupo"] == "float"
    quality.enforce(quality.pk_report(fact, enade.COURSE_KEYS))
    checks = [quality.in_range(c, 0, 100) for c in ("nt_ger_media", "nt_fg_media", "nt_ce_media", "percentil_grupo")]
    checks += [quality.in_range("tx_participacao", 0, 1), quality.no_nulls("co_ies")]
    checks.append(quality.row_rule("presentes", F.col("qt_presentes") <= F.col("qt_inscritos")))
    quality.enforce(quality.run_checks(fact, checks))
    quality.enforce(quality.layer_totals(fact, "qt_presentes", silver, F.col("tp_pres") == 555))
    quality.enforce(quality.year_coverage(fact, [2018, 2019], [2020]))


def test_profiles(spark, bronze, tmp_path):
    fact = enade.publish_profiles(spark, str(bronze), str(tmp_path / "data"))
    assert fact.columns[:3] == ["ano", "co_ies", "co_curso"]
    assert set(fact.columns[3:]) == {f"qe_i{q:02d}_{x}" for q in range(1, 27) for x in [*"ABCDEFGHIJK", "respondentes"]}
    got = {(r.ano, r.co_curso): r for r in fact.collect()}
    # Every course of a year with answers is present; the unknown course is not.
    assert set(got) == {(2018, 100), (2018, 101), (2018, 102), (2018, 103), (2019, 100)}
    one, two = got[2018, 100], got[2018, 101]
    assert (one.qe_i01_A, one.qe_i01_B) == (pytest.approx(2 / 3, abs=1e-6), pytest.approx(1 / 3, abs=1e-6))
    assert one.qe_i01_C is None and one.qe_i01_respondentes == 3 and one.qe_i02_A is None
    assert (two.qe_i01_A, two.qe_i01_B, two.qe_i02_A) == (0.0, 1.0, 1.0)
    assert got[2018, 103].qe_i01_respondentes is None and got[2019, 100].qe_i01_C == 1.0
    assert dict(fact.dtypes)["qe_i01_A"] == "float"


def test_missing_file_of_a_year_is_reported(spark, bronze, tmp_path):
    next((bronze / "enade-microdados" / "2019").rglob("*arq3.txt")).rename(tmp_path / "gone.txt")
    report = enade.build_students(spark, str(bronze), str(tmp_path / "d2"), [2018, 2019])
    assert report.written == [2018]
    assert report.failures == [{"ano_fonte": 2019, "check": "source_file", "violations": 1}]


def test_profiles_need_questionnaire_files(spark, bronze, tmp_path):
    with pytest.raises(ValueError):
        enade.publish_profiles(spark, str(bronze), str(tmp_path / "data"), [2010])
    assert rows(spark.range(0)) == []


def test_questionnaire_lines_keep_quoted_cells_and_upper_case_names(spark, tmp_path):
    folder = tmp_path / "2019" / "DADOS"
    folder.mkdir(parents=True)
    path = folder / "MICRODADOS2019_ARQ7.TXT"
    path.write_text('NU_ANO;"CO_CURSO";NOTE;QE_I01\n2019; 1 ;"a;b";A\n2019;"2";x;"B"\n')
    got = enade.questionnaire_rows(spark, {(2019, 7): str(path)}, {7: "QE_I01"})
    assert sorted((r.ano_fonte, r.co_curso, r.questao, r.resposta) for r in got.collect()) == [
        (2019, "1", "qe_i01", "A"), (2019, "2", "qe_i01", "B"),
    ]


def test_profile_against_brute_force(spark, tmp_path):
    """A whole profile build: quoted breaks, one course with most answers, years with other columns."""
    import csv
    import io
    import random

    rng = random.Random(6)
    root, counts, courses = tmp_path / "bronze", {}, {}
    for year in (2016, 2017):
        folder = root / "enade-microdados" / str(year) / "DADOS"
        codes = [100, 101, 102, 103]
        courses[year] = {c: c % 3 + 1 for c in codes}
        write_text(folder / f"microdados{year}_arq1.txt", "NU_ANO;CO_CURSO;CO_IES", *[f"{year};{c};{courses[year][c]}" for c in codes])
        for number, question in ((7, "QE_I01"), (8, "QE_I02")):
            header = ["NU_ANO", "OBS", "CO_CURSO", question] if year == 2016 else [question, "CO_CURSO", "NU_ANO", "OBS"]
            out = io.StringIO()
            writer = csv.writer(out, delimiter=";", lineterminator="\n")
            writer.writerow(header)
            for _ in range(400):
                course, answer = rng.choice([100, 100, 100, 101, 102, 999]), rng.choice(["A", "B", "C", "", "NA"])
                note = rng.choice(["ok", "duas\nlinhas", 'dito "alto"', "a;b\n\nc"])
                values = {"NU_ANO": year, "OBS": note, "CO_CURSO": course, question: answer}
                writer.writerow([values[c] for c in header])
                if answer in "ABC" and answer:
                    key = (year, course, question.lower())
                    counts.setdefault(key, {}).setdefault(answer, 0)
                    counts[key][answer] += 1
            (folder / f"microdados{year}_arq{number}.txt").write_bytes(out.getvalue().encode("latin-1"))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        profile = enade.publish_profiles(spark, str(root), str(tmp_path / "data"), [2016, 2017]).collect()
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
    assert {(r.ano, r.co_curso, r.co_ies) for r in profile} == {(y, c, i) for y, found in courses.items() for c, i in found.items()}
    for row in profile:
        for question in ("qe_i01", "qe_i02"):
            given = counts.get((row.ano, row.co_curso, question))
            total = sum(given.values()) if given else None
            assert row[f"{question}_respondentes"] == total
            for answer in "ABC":
                share = None if given is None else given.get(answer, 0) / total
                assert row[f"{question}_{answer}"] == (None if share is None else pytest.approx(share, abs=1e-6))
