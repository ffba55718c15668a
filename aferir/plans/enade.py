"""Student exam: cleaned student rows, course scores, and answer profiles of the questionnaire."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aferir.functions import values as V
from aferir.operators import reshape, stats
from aferir.operators.dedup import any_one
from aferir.operators.lookup import lookup_join
from aferir.plans.build import (
    BuildReport,
    gate_years,
    missing_columns,
    publish_gold,
    write_passing_years,
    years_to_build,
)
from aferir.schemas import enade
from aferir.schemas.common import EXAM_YEARS, YEARS_WITHOUT_EXAM
from aferir.session import materialise
from aferir.sources.delimited import LATIN1, POSITION, read_header, read_years_mapped, side_by_side
from aferir.sources.discovery import find_files, one_per_year
from aferir.sources.records import cells_of, read_records, unquoted
from aferir.sources.tables import SOURCE_YEAR, gold_path, read_years, silver_path

DATASET = "enade-microdados"
FILE_ORDER = (SOURCE_YEAR, *POSITION)
COURSE_KEYS = ["co_ies", "co_curso", "ano"]
# Published columns of the tables below.
COURSE_META = [
    "co_grupo", "tp_categoria_adm", "tp_org_academica", "tp_modalidade", "co_municipio", "co_uf",
    "co_regiao",
]
SPREAD_SCORES = ["nt_ger", "nt_fg", "nt_ce"]
MEAN_SCORES = ["nt_obj_fg", "nt_obj_ce", "nt_dis_fg", "nt_dis_ce"]


def student_rows(students: DataFrame, courses: DataFrame) -> DataFrame:
    """Students with the description of their course, typed leniently; rows without codes dropped.

    Course codes are compared as text inside one source year.
    """
    fields = [c for c in enade.COURSE_FILE.columns if c not in ("ano", "co_curso")]
    joined = lookup_join(students, courses, [SOURCE_YEAR, "co_curso"], fields)
    typed = reshape.cast_lenient(joined, enade.SILVER_TYPES)
    return reshape.require_keys(typed, ["co_ies", "co_curso"])


def build_students(
    spark: SparkSession, bronze: str, root: str, years: Sequence[int], force: bool = False
) -> BuildReport:
    report = BuildReport("enade_microdados")
    years = [y for y in years if y not in YEARS_WITHOUT_EXAM]
    found = {
        number: one_per_year(
            find_files(spark, bronze, DATASET, rf"microdados\d{{4}}_arq{number}\.txt", years)
        )
        for number in (1, 3)
    }
    complete = [y for y in years if all(y in files for files in found.values())]
    report.failures += [
        {SOURCE_YEAR: y, "check": "source_file", "violations": 1} for y in years if y not in complete
    ]
    path = silver_path(root, report.table)
    sources = [files[y] for files in found.values() for y in complete]
    stale = years_to_build(spark, sources, path, force) if sources else []
    report.unchanged = [y for y in complete if y not in stale]
    if not stale:
        return report
    paths = {number: {y: files[y].path for y in stale} for number, files in found.items()}
    arq1, arq3 = enade.COURSE_FILE, enade.STUDENT_FILE
    courses, in_courses = read_years_mapped(spark, paths[1], arq1.headers, arq1.columns)
    students, in_students = read_years_mapped(
        spark, paths[3], arq3.headers, arq3.columns, position=True, quoted_breaks=True
    )
    # Gates and write share one computation.
    rows = materialise(student_rows(students, courses))
    published = {y: in_courses[y] | in_students[y] for y in stale}
    failures = missing_columns(published, lambda year: enade.REQUIRED)
    failures += gate_years(rows, stale, enade.KEYS)
    return write_passing_years(rows, path, report, stale, failures)


def course_scores(silver: DataFrame) -> DataFrame:
    """fact_enade: enrolment, presence, scores and position inside the area, per course and year."""
    scored = stats.score_stats(
        silver, COURSE_KEYS, F.col("tp_pres") == enade.PRESENT, SPREAD_SCORES, MEAN_SCORES,
        COURSE_META, FILE_ORDER, by_range=True,
    )
    scores = [c for c in scored.columns if c.startswith("nt_")]
    scored = reshape.cast_strict(stats.participation(scored), dict.fromkeys([*scores, "tx_participacao"], "float"))
    ties = ["co_ies", "co_curso"]
    placed = stats.group_percentile(scored, ["co_grupo", "ano"], "nt_ger_media", ties, by_range=True)
    return reshape.cast_strict(placed, {"percentil_grupo": "float"})


def publish_scores(spark: SparkSession, root: str) -> DataFrame:
    fact = course_scores(read_years(spark, root, "enade_microdados"))
    return publish_gold(fact, gold_path(root, "fact_enade"), COURSE_KEYS, COURSE_KEYS)


# --- questionnaire ------------------------------------------------------------------------------


def _numbered_files(spark: SparkSession, bronze: str, years: Sequence[int]) -> dict[tuple[int, int], str]:
    """(year, file number) -> path, inside the data folders of the exam."""
    name = r"microdados\d{4}_arq\d+\.txt"
    numbered: dict[tuple[int, int], str] = {}
    for f in find_files(spark, bronze, DATASET, name, years):
        folder, _, file = f.path.rpartition("/")
        prefix = f"microdados{f.year}_arq"
        if folder.endswith(("/DADOS", "/2.DADOS", "/2. DADOS")) and file.lower().startswith(prefix):
            numbered.setdefault((f.year, int(file[len(prefix):-len(".txt")])), f.path)
    return numbered


def questionnaire_rows(
    spark: SparkSession, files: dict[tuple[int, int], str], columns: dict[int, str]
) -> DataFrame | None:
    """Long rows (source year, course text, question, answer) of all files in one scan.

    ``columns`` names the answer column of each file number. The headers (one short line per file)
    say where the two wanted cells are, so files whose columns differ share one plan.
    """
    places = []
    wanted = {key: path for key, path in files.items() if key[1] in columns}
    headers = side_by_side(lambda path: read_header(spark, path), wanted.values())
    for ((year, number), path), header in zip(wanted.items(), headers):
        if "CO_CURSO" in header and columns[number] in header:
            places.append(
                (year, number, columns[number].lower(), header.index("CO_CURSO"),
                 header.index(columns[number]), path)
            )
    if not places:
        return None
    positions = spark.createDataFrame(
        [p[:5] for p in places],
        f"{SOURCE_YEAR} int, _arq int, questao string, _curso int, _resposta int",
    )
    name = r"(?i)microdados(\d{4})_arq(\d+)\.txt"
    records = read_records(spark, [p[5] for p in places]).where("bloco > 0 OR linha > 0")
    lines = records.select(
        F.regexp_extract("fonte", name, 1).try_cast("int").alias(SOURCE_YEAR),
        F.regexp_extract("fonte", name, 2).try_cast("int").alias("_arq"),
        cells_of(F.decode("registro", LATIN1)).alias("_cells"),
    )

    def cell(at: str):
        return V.drop_null_tokens(V.strip_quotes(unquoted(F.get("_cells", F.col(at)))))

    # At most 26 questions times the exam years.
    placed = lines.join(F.broadcast(positions), [SOURCE_YEAR, "_arq"])
    return placed.select(
        SOURCE_YEAR, cell("_curso").alias("co_curso"), "questao", cell("_resposta").alias("resposta")
    )


def course_institutions(spark: SparkSession, files: dict[tuple[int, int], str]) -> DataFrame:
    """Source year, course text and institution text, one row per course."""
    paths = {year: path for (year, number), path in files.items() if number == 1}
    headers = {"CO_CURSO": "co_curso", "CO_IES": "co_ies"}
    codes, _ = read_years_mapped(spark, paths, headers, list(headers.values()))
    return any_one(codes, [SOURCE_YEAR, "co_curso"])


def answer_shares(courses: DataFrame, answers: DataFrame) -> DataFrame:
    """fact_enade_perfil: answer shares of every course of the years that have answers."""
    given = dict.fromkeys((q.lower() for q in enade.QUESTIONS), enade.ANSWERS)
    profile = stats.answer_profile(answers, SOURCE_YEAR, ["co_curso"], given)
    shares = [c for c in profile.columns if c not in (SOURCE_YEAR, "co_curso")]
    # One row per exam year.
    asked = answers.where(F.col("resposta").isNotNull()).select(SOURCE_YEAR).distinct()
    joined = courses.join(asked, SOURCE_YEAR, "left_semi").join(profile, [SOURCE_YEAR, "co_curso"], "left")
    typed = reshape.cast_lenient(
        joined.withColumnRenamed(SOURCE_YEAR, "ano"),
        {
            "ano": "int", "co_curso": "bigint", "co_ies": "bigint",
            **{c: "int" if c.endswith("_respondentes") else "float" for c in shares},
        },
    )
    keys = ["ano", "co_ies", "co_curso"]
    return reshape.keys_first(reshape.require_keys(typed, ["co_curso", "co_ies"]), keys)


def publish_profiles(
    spark: SparkSession, bronze: str, root: str, years: Sequence[int] = EXAM_YEARS
) -> DataFrame:
    files = _numbered_files(spark, bronze, [y for y in years if y not in YEARS_WITHOUT_EXAM])
    known = {year for year, number in files if number == 1}
    files = {key: path for key, path in files.items() if key[0] in known}
    answers = questionnaire_rows(spark, files, {n: q for q, n in enade.QUESTIONS.items()})
    if answers is None:
        raise ValueError("no questionnaire files in the given years")
    fact = answer_shares(course_institutions(spark, files), answers)
    path = gold_path(root, "fact_enade_perfil")
    return publish_gold(fact, path, COURSE_KEYS, COURSE_KEYS, unique=False)
