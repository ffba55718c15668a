"""Every registered query, as a callable on (spark, folder of the test tables).

The operators are generic; here suppliers, parts, orders and customers stand in for institutions,
courses, years and students. Money is handled in cents, so sums do not depend on the row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aferir.functions import values as V
from aferir.operators import dedup, lookup, order, quality, reshape, stats
from aferir.plans import census, enade, indicators
from aferir.schemas import enade as schemas
from aferir.sinks import refresh
from aferir.sources import infer

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cents(column: str):
    return F.round(F.col(column) * 100).cast("bigint")


def orders_by_year(spark, folder) -> DataFrame:
    return table(spark, folder, "orders").withColumn("ano", F.year("o_orderdate"))


def students(spark, folder) -> DataFrame:
    """lineitem as exam rows: supplier = course, return flag = area, line status F = present."""
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("co_curso"),
        F.col("l_returnflag").alias("co_grupo"),
        F.year("l_shipdate").alias("ano"),
        F.when(F.col("l_linestatus") == "F", 555).otherwise(222).alias("tp_pres"),
        cents("l_extendedprice").cast("double").alias("nt_ger"),
    )


COURSE_KEYS = ["co_curso", "co_grupo", "ano"]


def course_stats(spark, folder, **options) -> DataFrame:
    rows = students(spark, folder)
    return stats.score_stats(rows, COURSE_KEYS, F.col("tp_pres") == 555, ["nt_ger"], **options)


# --- projections, casts, text -------------------------------------------------------------------

LINE_MAP = {
    "l_orderkey": "co_curso",
    "l_suppkey": "co_ies",
    "l_linenumber": "nu_item",
    "l_quantity": "qt_itens",
    "l_extendedprice": "vl_bruto",
    "l_returnflag": "sg_retorno",
    "l_not_published": "vl_ausente",
}
LINE_TYPES = {"co_curso": "bigint", "co_ies": "int", "nu_item": "bigint", "qt_itens": "int"}


@query
def q01_typed_projection(spark, folder):
    mapped = reshape.select_mapped(table(spark, folder, "lineitem"), LINE_MAP)
    return reshape.cast_strict(mapped, LINE_TYPES)


@query
def q02_lenient_cast(spark, folder):
    part = table(spark, folder, "part")
    padded = F.concat(F.lit("\t "), F.substring_index("p_brand", "#", -1), F.lit(" "))
    texts = part.select(
        "p_partkey",
        V.strip_text(padded).alias("nu_marca"),
        F.col("p_type").alias("nu_tipo"),
        V.strip_quotes(F.concat(F.lit('" '), F.col("p_size"), F.lit(' "'))).alias("nu_tamanho"),
    )
    return reshape.cast_lenient(texts, dict.fromkeys(("nu_marca", "nu_tipo", "nu_tamanho"), "int"))


@query
def q03_null_tokens(spark, folder):
    tokens = (*V.NULL_TOKENS, "4-NOT SPECIFIED")
    priority = V.drop_null_tokens(F.col("o_orderpriority"), tokens)
    return table(spark, folder, "orders").select("o_orderkey", priority.alias("prioridade"))


ORDER_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "vl_total": "double"}


def drifting_orders(spark, folder) -> DataFrame:
    """Two publications of orders: the older keeps keys as text and lacks the total."""
    orders = orders_by_year(spark, folder)
    recent = F.coalesce(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"), F.lit(False))
    older = orders.where(~recent).select(
        "ano", F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_custkey", "o_orderstatus"
    )
    newer = orders.where(recent).select(
        "ano", "o_custkey", "o_orderkey", F.col("o_totalprice").alias("vl_total")
    )
    return reshape.diagonal_union([reshape.cast_strict(f, ORDER_TYPES) for f in (older, newer)])


@query
def q04_diagonal_union(spark, folder):
    return drifting_orders(spark, folder)


@query
def q05_keep_first(spark, folder):
    ties = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax", "l_returnflag", "l_linestatus"]
    first = dedup.keep_first(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"], ties)
    return first.drop("l_shipdate")


STATUS_LABELS = {"F": "Fechado", "O": "Aberto"}


@query
def q06_decode_labels(spark, folder):
    label = V.decode(F.col("o_orderstatus"), STATUS_LABELS)
    return table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", label.alias("situacao"))


# --- history and latest state -------------------------------------------------------------------


@query
def q07_history(spark, folder):
    labelled = orders_by_year(spark, folder).select(
        "o_custkey", "ano", "o_orderdate", "o_orderkey", "o_orderstatus",
        V.decode(F.col("o_orderstatus"), STATUS_LABELS).alias("situacao"),
    )
    first = dedup.keep_first(labelled, ["o_custkey", "ano"], ["o_orderdate", "o_orderkey"])
    return first.drop("o_orderdate")


@query
def q08_latest_dim(spark, folder):
    state = ["o_orderstatus", "o_orderpriority", "o_totalprice"]
    orders = orders_by_year(spark, folder).withColumnRenamed("o_custkey", "c_custkey")
    latest = dedup.latest_per_key(orders, ["c_custkey"], "ano", ["o_orderdate", "o_orderkey"])
    latest = reshape.suffix_columns(latest, state, "_atual").withColumnRenamed("ano", "ano_referencia")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    kept = latest.select("c_custkey", "ano_referencia", *[f"{c}_atual" for c in state])
    return customer.join(kept, "c_custkey", "left")


@query
def q09_threshold_flag(spark, folder):
    size = F.nullif(F.col("p_size"), F.lit(50))
    return table(spark, folder, "part").select(
        "p_partkey", size.alias("tp_categoria"), V.network_of_category(size).alias("tp_rede")
    )


# --- lookups and cascade ------------------------------------------------------------------------


@query
def q10_unambiguous_lookup(spark, folder):
    orders = table(spark, folder, "orders")
    return lookup.unambiguous(orders, ["o_custkey", "o_orderpriority"], "o_orderkey", "co_pedido")


def cascaded(spark, folder) -> DataFrame:
    """Supplier / part / flag triples whose order is recovered from finished, then open lines."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("co_ies"), F.col("l_partkey").alias("co_area"),
        F.col("l_returnflag").alias("co_municipio"), F.col("l_orderkey").alias("co_curso"),
        "l_linestatus",
    )
    keys = ["co_ies", "co_area"]
    base = dedup.distinct_rows(lines.select(*keys, "co_municipio"))
    direct = lines.where("l_linestatus = 'F'").drop("l_linestatus")
    micro = lines.where("l_linestatus = 'O'").drop("l_linestatus")
    return lookup.enrich_codes(base, micro, direct, keys)


@query
def q11_cascade_enrich(spark, folder):
    return cascaded(spark, folder)


@query
def q12_sentinel(spark, folder):
    coded = cascaded(spark, folder).withColumn("co_curso", V.fill(F.col("co_curso"), V.UNKNOWN_COURSE))
    known = F.col("co_curso") != V.UNKNOWN_COURSE
    return coded.groupBy("co_municipio").agg(
        F.count("*").alias("linhas"),
        F.count_if(~known).alias("sem_curso"),
        F.countDistinct(F.when(known, F.col("co_curso"))).alias("cursos"),
    )


@query
def q13_lookup_join(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("co_curso"), "l_quantity"
    )
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("co_curso"),
        F.nullif(F.col("p_size"), F.lit(50)).cast("string").alias("co_ies"),
        "p_brand",
    )
    joined = lookup.lookup_join(lines, parts, ["co_curso"], ["co_ies", "p_brand"])
    typed = reshape.cast_lenient(joined, {"co_curso": "bigint", "co_ies": "int"})
    return reshape.require_keys(typed, ["co_ies", "co_curso"])


# --- score statistics ---------------------------------------------------------------------------


@query
def q14_score_stats(spark, folder):
    in_money = {c: F.col(c) / 100 for c in ("nt_ger_media", "nt_ger_mediana")}
    deviation = F.round(F.col("nt_ger_dp") / 100, 4)
    return course_stats(spark, folder).withColumns({**in_money, "nt_ger_dp": deviation})


@query
def q15_participation(spark, folder):
    counted = stats.participation(course_stats(spark, folder, medians=()))
    return counted.select(*COURSE_KEYS, "qt_inscritos", "qt_presentes", "tx_participacao")


@query
def q16_group_percentile(spark, folder):
    rated = stats.participation(course_stats(spark, folder))
    placed = stats.group_percentile(rated, ["co_grupo", "ano"], "nt_ger_media", ["co_curso"])
    in_money = {c: F.col(c) / 100 for c in ("nt_ger_media", "nt_ger_mediana")}
    return placed.withColumns({**in_money, "nt_ger_dp": F.round(F.col("nt_ger_dp") / 100, 4)})


# --- answer profiles ----------------------------------------------------------------------------


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def survey_answers(spark, folder) -> DataFrame:
    events = table(spark, folder, "events").select(
        "user_id", F.dayofmonth("ts").alias("dia"), "event_type",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    return events


@query
def q17_answer_distribution(spark, folder):
    answers = survey_answers(spark, folder).select(
        F.lit(0).alias("periodo"), "user_id",
        F.lit("qe_i01").alias("questao"), F.col("event_type").alias("resposta"),
    )
    return stats.answer_profile(answers, "periodo", ["user_id"], {"qe_i01": EVENT_TYPES}).drop("periodo")


@query
def q18_profile_wide(spark, folder):
    given = {"qe_i01": EVENT_TYPES, "qe_i02": ("A", "B")}
    profile = stats.answer_profile(two_questions(spark, folder), "dia", ["user_id"], given)
    return reshape.keys_first(profile, ["dia", "user_id"])


@query
def q46_profile_long(spark, folder):
    """Every answer given, one row each; the wide table is made from a list of answers."""
    shares = stats.answer_shares(two_questions(spark, folder), "dia", ["user_id"])
    return shares.withColumn("parte", F.round("parte", 9))


def two_questions(spark, folder) -> DataFrame:
    return survey_answers(spark, folder).select(
        "dia", "user_id",
        F.inline(
            F.array(
                F.struct(F.lit("qe_i01").alias("questao"), F.col("event_type").alias("resposta")),
                F.struct(
                    F.lit("qe_i02").alias("questao"),
                    F.when(F.col("k") < 30, F.lit("A")).when(F.col("k") < 60, F.lit("B")).alias("resposta"),
                ),
            )
        ),
    )


# --- conditional rules --------------------------------------------------------------------------


def graded_orders(spark, folder) -> DataFrame:
    """Orders as graded courses: the priority is the band, 5-LOW stands for "no grade"."""
    priority = F.col("o_orderpriority")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(priority == "5-LOW", F.lit(" SC ")).when(priority == "4-NOT SPECIFIED", F.lit(None))
        .otherwise(F.substring(priority, 1, 1)).alias("idd_faixa"),
        F.when(F.col("o_orderstatus") == "P", F.lit("sem conceito"))
        .when(F.col("o_orderstatus") == "O", F.lit("  ")).alias("observacao"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("idd_continuo"),
        F.col("o_totalprice").alias("nota_bruta_idd"),
    )


def flagged_orders(spark, folder) -> DataFrame:
    graded = graded_orders(spark, folder)
    flag = V.no_grade_flag(F.col("idd_faixa"), F.col("observacao"))
    flagged = graded.withColumn("in_sem_conceito", flag)
    hidden = ("idd_faixa", "idd_continuo", "nota_bruta_idd")
    return flagged.withColumns({c: V.hide_when(F.col("in_sem_conceito"), F.col(c)) for c in hidden})


@query
def q19_no_grade_flag(spark, folder):
    return flagged_orders(spark, folder).drop("observacao")


@query
def q20_outlier_repair(spark, folder):
    typed = reshape.cast_lenient(flagged_orders(spark, folder), {"idd_faixa": "int"})
    repaired = V.repair_outlier(
        F.col("nota_bruta_idd"), F.col("idd_continuo"), F.col("idd_faixa"), F.col("in_sem_conceito")
    )
    return typed.select("o_orderkey", "idd_faixa", repaired.alias("idd_continuo"))


@query
def q21_year_fill(spark, folder):
    sheets = orders_by_year(spark, folder).select(
        F.col("o_orderpriority").alias("fonte"), F.col("o_orderkey").alias("_linha"),
        F.when(F.col("o_orderstatus") == "F", F.col("ano")).alias("ano"),
    )
    filled = reshape.fill_from_source(sheets, "ano", "_linha")
    return filled.groupBy("fonte", "ano").agg(F.count("*").alias("linhas"))


@query
def q22_cebas(spark, folder):
    text = (
        F.when(F.col("l_returnflag") == "N", F.lit("-"))
        .when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F"), F.lit("X"))
        .when(F.col("l_returnflag") == "A", F.lit("Sim"))
        .when(F.col("l_linestatus") == "O", F.lit("outro"))
    )
    lines = table(spark, folder, "lineitem").select(text.alias("texto"))
    return lines.groupBy(
        "texto", V.cebas_flag(F.col("texto")).alias("in_cebas"), V.cebas_code(F.col("texto")).alias("co_cebas")
    ).agg(F.count("*").alias("linhas"))


SHEET_MAP = {
    "Código da IES": "co_ies",
    "Nome da IES": "no_ies",
    "Nome da IES*": "no_ies",
    "Observação": "_obs",
    "código da área": "co_area",
    "Código da Área": "co_area",
}


@query
def q23_canonical_columns(spark, folder):
    customer = table(spark, folder, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", "c_acctbal", "c_nationkey",
        F.col("c_nationkey") + 1, F.col("c_mktsegment"), F.col("c_acctbal"),
    )
    published = customer.toDF(
        "Código da IES", "Nome da IES", "Nome da IES*", "Observação", "código da área",
        "Código da Área", "Segmento de Mercado", "saldo",
    )
    return reshape.canonical_only(reshape.rename_first_wins(published, SHEET_MAP))


@query
def q24_footer_filter(spark, folder):
    nation = F.col("c_nationkey")
    sheet = table(spark, folder, "customer").select(
        F.when(nation == 0, F.concat(F.lit("Fonte: "), "c_name"))
        .when(nation == 1, F.concat(F.col("c_custkey").cast("string"), F.lit("\n")))
        .when(nation != 2, F.col("c_custkey").cast("string")).alias("co_ies"),
        F.when(nation != 2, F.col("c_mktsegment")).alias("no_ies"),
    )
    return reshape.numeric_code_rows(reshape.keep_any_value(sheet), "co_ies")


# --- data quality -------------------------------------------------------------------------------


@query
def q25_dq_report(spark, folder):
    lines = table(spark, folder, "lineitem")
    checks = [
        quality.not_empty(),
        quality.no_nulls("l_orderkey"),
        quality.no_nulls("l_linenumber"),
        quality.in_range("l_discount", 0.0, 0.05),
        quality.in_range("l_quantity", 1, 50),
        quality.row_rule("imposto_ate_desconto", F.col("l_tax") <= F.col("l_discount")),
    ]
    return quality.run_checks(lines, checks)


@query
def q26_pk_report(spark, folder):
    return quality.pk_duplicates(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def q27_fk_orphans(spark, folder):
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("c_custkey"))
    solvent = table(spark, folder, "customer").where("c_acctbal >= 0")
    return quality.fk_report(orders, solvent, "c_custkey", 10)


@query
def q28_reconcile(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", cents("o_totalprice").alias("total"))
    lines = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.sum(cents("l_extendedprice")).alias("soma")
    )
    return quality.reconcile(orders, lines, ["o_orderkey"], "total", "soma", 5_000_000, 100_000_000)


@query
def q29_layer_totals(spark, folder):
    rows = students(spark, folder)
    return quality.layer_totals(course_stats(spark, folder, medians=()), "qt_presentes", rows, F.col("tp_pres") == 555)


@query
def q30_year_summary(spark, folder):
    summary = stats.year_summary(course_stats(spark, folder, medians=()), "nt_ger_media")
    return summary.withColumn("media_geral", F.round(F.col("media_geral") / 100, 4))


@query
def q31_build_summary(spark, folder):
    lines = table(spark, folder, "lineitem").withColumn("ano", F.year("l_shipdate"))
    lines = lines.withColumn("nota", F.when(F.col("l_linestatus") == "F", F.col("l_quantity")))
    return stats.build_summary(
        lines,
        {"ies": "l_suppkey", "cursos": "l_partkey"},
        {"devolvidos": F.col("l_returnflag") == "R"},
        ["nota"],
    )


@query
def q32_schema_drift(spark, folder):
    union = drifting_orders(spark, folder)
    columns = [c for c in union.columns if c != "ano"]
    return quality.schema_drift(quality.filled_columns(union, columns))


# --- years, refresh, headers --------------------------------------------------------------------


@query
def q33_stale_years(spark, folder):
    sources = orders_by_year(spark, folder).groupBy("ano").agg(F.max("o_orderdate").alias("modificado"))
    outputs = (
        table(spark, folder, "lineitem").where("l_returnflag = 'A'")
        .groupBy(F.year("l_shipdate").alias("ano")).agg(F.max("l_shipdate").alias("modificado"))
        .where("ano <> 1997")
    )
    return refresh.stale_years(sources, outputs)


@query
def q34_year_spec(spark, folder):
    years = reshape.parse_years("1995,1997-1999", skip=[1998])
    kept = reshape.where_years(orders_by_year(spark, folder), years)
    return kept.groupBy("ano").agg(
        F.count("*").alias("pedidos"), (F.sum(cents("o_totalprice")) / 100).alias("total")
    )


@query
def q35_header_promotion(spark, folder):
    customer = table(spark, folder, "customer")
    code, segment, balance = (F.col("c_custkey").cast("string"), F.col("c_mktsegment"),
                              F.round("c_acctbal").cast("bigint").cast("string"))
    # Nations below 12 publish another column order, another spelling and no balance.
    early = F.col("c_nationkey") < 12
    data = customer.select(
        F.col("c_nationkey").alias("fonte"), F.lit(2).alias("linha"),
        F.when(early, F.array(segment, F.lit("x"), code)).otherwise(F.array(code, segment, balance)).alias("cells"),
    )
    header = customer.select(F.col("c_nationkey").alias("fonte"), early.alias("e")).distinct().select(
        "fonte", F.lit(1).alias("linha"),
        F.when(F.col("e"), F.array(F.lit("Segmento*"), F.lit("Obs"), F.lit(" CÓDIGO  da IES")))
        .otherwise(F.array(F.lit("Código da IES"), F.lit("Segmento"), F.lit("Saldo"))).alias("cells"),
    )
    rows = header.unionByName(data)
    aliases = spark.createDataFrame(
        [("codigo da ies", "co_ies"), ("segmento", "no_segmento"), ("saldo", "vl_saldo")],
        "header string, target string",
    )
    first = F.col("linha") == 1
    wide = reshape.promote_header(
        rows, first, reshape.header_positions(rows, first, aliases), ["co_ies", "no_segmento", "vl_saldo"]
    )
    return reshape.cast_lenient(wide.drop("linha"), {"co_ies": "bigint", "vl_saldo": "bigint"})


@query
def q36_coverage(spark, folder):
    union = drifting_orders(spark, folder)
    covered = quality.year_coverage(union, [*range(1995, 1999), 2000, 2001, 2002], forbidden=[1999])
    total_years = [
        y for y in range(1995, 2003)
        if "vl_total" in quality.required_for_year(["vl_total"], y, {"vl_total": (1995, 1996, 1997)})
    ]
    needs_total = F.col("ano").isin(*total_years)
    lacking = union.groupBy("ano").agg(
        F.count_if(needs_total & F.col("vl_total").isNull()).alias("sem_total")
    )
    return covered.join(lacking, "ano", "left").withColumn("sem_total", V.fill(F.col("sem_total"), 0))


@query
def q37_preview(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return refresh.preview(orders, [F.desc("o_totalprice"), "o_orderkey"])


@query
def q38_gold_fallback_flag(spark, folder):
    graded = graded_orders(spark, folder)
    flag = V.fallback_no_grade_flag(F.col("idd_faixa"), F.col("observacao"))
    return graded.select("o_orderkey", "idd_faixa", "observacao", flag.alias("in_sem_conceito")).drop("observacao")


@query
def q39_code_lookup(spark, folder):
    """Quoted code texts to a distinct, complete code table."""
    place = F.when(F.col("l_returnflag") == "N", F.lit("x")).otherwise(F.col("l_linenumber").cast("string"))
    raw = table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("co_ies"), F.col("l_partkey").alias("co_grupo"), place.alias("co_munic_curso")
    )
    stripped = raw.select(
        *[V.strip_quotes(F.concat(F.lit('"'), c, F.lit('" '))).alias(c) for c in raw.columns]
    )
    typed = reshape.cast_lenient(stripped, dict.fromkeys(stripped.columns, "bigint"))
    # One distinct: texts that differ only in quotes or are no code meet after typing.
    return dedup.distinct_rows(reshape.complete_rows(typed))


@query
def q40_value_range(spark, folder):
    return stats.value_range(
        table(spark, folder, "customer").select(cents("c_acctbal").alias("saldo"), "c_nationkey"),
        ["saldo", "c_nationkey"],
    )


@query
def q41_orphan_keys(spark, folder):
    lines = table(spark, folder, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    sized = table(spark, folder, "part").where("p_size <= 40")
    return quality.orphan_keys(lines, sized, "p_partkey")


@query
def q42_pk_summary(spark, folder):
    return quality.pk_report(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def q43_hot_group_median(spark, folder):
    """Exact medians of very large groups, each spread over several partitions."""
    rows = table(spark, folder, "lineitem").select(
        "l_returnflag", cents("l_extendedprice").cast("double").alias("nota")
    )
    medians = order.exact_medians_by_range(rows, ["l_returnflag"], ["nota"])
    return medians.select("l_returnflag", (F.col("nota_mediana") / 100).alias("mediana"))


@query
def q44_hot_group_rank(spark, folder):
    """Ordinal ranks inside very large groups, each spread over several partitions."""
    rows = table(spark, folder, "orders").select(
        "o_orderstatus", "o_orderkey", cents("o_totalprice").cast("double").alias("nota")
    )
    ranked = order.ordinal_rank_by_range(rows, ["o_orderstatus"], ["nota", "o_orderkey"], "posicao")
    return ranked.drop("nota")


@query
def q45_rename_keep(spark, folder):
    """Rename some columns, keep the rest; add a constant and a typed null column."""
    renamed = reshape.rename_keep(
        table(spark, folder, "supplier"), {"s_suppkey": "co_ies", "s_name": "no_ies", "absent": "x"}
    )
    return reshape.conform(renamed, {"co_ies": "bigint", "co_area": "bigint"}).withColumn("ano", F.lit(2023))


# --- published cleaning rules and gold tables ---------------------------------------------------


def indicator_lines(spark, folder) -> DataFrame:
    """lineitem as cleaned indicator rows: supplier = institution, part = area, order = course."""
    return table(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("co_ies"),
        F.col("l_partkey").alias("co_area"),
        F.year("l_shipdate").alias("ano"),
        F.when(F.col("l_returnflag") != "N", F.col("l_orderkey")).alias("co_curso"),
        cents("l_extendedprice").alias("cpc_continuo"),
        F.lit(None).cast("string").alias("Coluna Solta"),
        F.year("l_shipdate").alias("ano_fonte"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("_linha"),
    )


@query
def q47_fact_cpc(spark, folder):
    return indicators.fact_cpc(indicator_lines(spark, folder))


def idd_orders(spark, folder) -> DataFrame:
    """Orders as text rows of the difference sheet; the year stands in the first rows only."""
    orders = orders_by_year(spark, folder)
    graded = graded_orders(spark, folder).select("o_orderkey", "idd_faixa", "observacao")
    return orders.join(graded, "o_orderkey").select(
        F.col("o_custkey").cast("string").alias("co_ies"),
        F.pmod(F.col("o_orderkey"), F.lit(7)).cast("string").alias("co_curso"),
        F.when(F.pmod(F.col("o_orderkey"), F.lit(100)) == 1, F.col("ano")).cast("string").alias("ano"),
        "idd_faixa",
        "observacao",
        F.when(F.col("o_orderstatus") != "F", cents("o_totalprice")).cast("string").alias("idd_continuo"),
        cents("o_totalprice").cast("string").alias("nota_bruta_idd"),
        F.when(F.col("o_orderstatus") == "F", "X").when(F.col("o_orderstatus") == "O", "-").alias("in_cebas"),
        F.col("ano").cast("string").alias("fonte"),
        F.col("ano").alias("ano_fonte"),
        F.col("o_orderkey").alias("_linha"),
    )


def cleaned_idd(spark, folder) -> DataFrame:
    texts = idd_orders(spark, folder)
    return indicators.clean_idd(texts, {1998: {"ano", "co_ies"}, 1999: set(texts.columns)})


@query
def q48_clean_idd(spark, folder):
    return cleaned_idd(spark, folder).drop("observacao")


@query
def q49_fact_idd(spark, folder):
    return indicators.fact_idd(cleaned_idd(spark, folder).drop("fonte"))


@query
def q50_clean_igc(spark, folder):
    orders = orders_by_year(spark, folder)
    texts = orders.select(
        F.col("o_custkey").cast("string").alias("co_ies"),
        F.when(F.col("o_orderstatus") != "P", F.col("ano")).cast("string").alias("ano"),
        cents("o_totalprice").cast("string").alias("igc_continuo"),
        F.substring("o_orderpriority", 1, 1).alias("igc_faixa"),
        F.when(F.col("o_orderstatus") == "F", "Sim").when(F.col("o_orderstatus") == "O", "-").alias("in_cebas"),
        F.col("ano").alias("ano_fonte"),
        F.col("o_orderkey").alias("_linha"),
    )
    return indicators.clean_igc(texts, {})


@query
def q51_fact_igc(spark, folder):
    return indicators.fact_igc(q50_clean_igc(spark, folder))


def census_rows(spark, folder) -> DataFrame:
    """Orders as yearly institution rows: customer = institution, priority = category."""
    return orders_by_year(spark, folder).select(
        F.col("o_custkey").alias("co_ies"),
        "ano",
        F.col("o_orderpriority").alias("no_ies"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("tp_categoria_adm"),
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 4).alias("tp_org_academica"),
        F.lit(None).cast("int").alias("tp_rede"),
        F.col("o_orderstatus").alias("sg_uf"),
        F.col("ano").alias("ano_fonte"),
        F.lit(0).cast("bigint").alias("_bloco"),
        F.col("o_orderkey").alias("_linha"),
    )


def networked(spark, folder) -> DataFrame:
    """The network is published from 1998 on only; before, it follows from the category."""
    rows = census_rows(spark, folder)
    published = {y: {"tp_rede"} if y >= 1998 else set() for y in range(1990, 2003)}
    return census.derive_network(rows, published)


@query
def q52_history(spark, folder):
    return census.history(networked(spark, folder))


@query
def q53_latest_institutions(spark, folder):
    return census.latest_institutions(networked(spark, folder))


@query
def q54_one_per_course(spark, folder):
    return census.one_per_key(indicator_lines(spark, folder).withColumn("_bloco", F.col("co_area")), ["co_ies", "ano"])


@query
def q55_student_rows(spark, folder):
    """Exam rows with the description of their course, matched as text inside the source year."""
    lines = table(spark, folder, "lineitem").select(
        F.year("l_shipdate").alias("ano_fonte"),
        F.year("l_shipdate").cast("string").alias("ano"),
        F.when(F.col("l_linenumber") == 7, "x").otherwise(F.col("l_partkey").cast("string")).alias("co_curso"),
        F.col("l_quantity").cast("int").cast("string").alias("nt_ger"),
        F.col("l_linenumber").cast("string").alias("tp_pres"),
    )
    years = lines.select("ano_fonte").distinct()
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("co_curso"),
        F.when(F.col("p_size") != 50, F.col("p_size").cast("string")).alias("co_ies"),
        F.col("p_size").cast("string").alias("co_grupo"),
    )
    fields = [c for c in schemas.COURSE_FILE.columns if c not in ("ano", "co_curso")]
    # Dealt before they are repeated for every year: a file of one row group is one task.
    parts = parts.repartition("co_curso", "co_ies", "co_grupo")
    courses = reshape.conform(parts.crossJoin(F.broadcast(years)), dict.fromkeys(fields, "string"))
    joined = enade.student_rows(lines, courses)
    return joined.select("ano_fonte", "ano", "co_curso", "co_ies", "co_grupo", "nt_ger", "tp_pres")


@query
def q56_required_columns(spark, folder):
    """Required columns and exact types as report rows."""
    lines = table(spark, folder, "lineitem")
    return quality.columns_report(lines, ["l_orderkey", "l_ausente"]).select("check", "ok").unionByName(
        quality.types_report(lines, {"l_orderkey": "bigint", "l_quantity": "int", "l_ausente": "int"}).select("check", "ok")
    )


@query
def q57_identified_only(spark, folder):
    coded = indicator_lines(spark, folder).withColumn("co_curso", V.fill(F.col("co_curso"), V.UNKNOWN_COURSE))
    return reshape.identified_only(coded).groupBy("ano").agg(
        F.count("*").alias("linhas"), F.countDistinct("co_curso").alias("cursos")
    )


# --- inference and bitmaps ----------------------------------------------------------------------


@query
def q58_inferred_types(spark, folder):
    """Types of text columns per year, each inferred over all its values."""
    year = F.year("o_orderdate")
    texts = table(spark, folder, "orders").select(
        year.alias("ano"),
        F.col("o_orderkey").cast("string").alias("chave"),
        (F.col("o_custkey") * 10_000_000).cast("string").alias("grande"),
        F.col("o_totalprice").cast("string").alias("preco"),
        F.when(year % 2 == 1, F.floor("o_totalprice").cast("string")).otherwise(F.col("o_orderpriority")).alias("misto"),
        F.when(F.col("o_orderstatus") == "P", "NA").alias("vazia"),
    )
    return infer.column_types(texts, ["chave", "grande", "preco", "misto", "vazia"], ["ano"])


@query
def q59_bitmap_counts(spark, folder):
    """Distinct codes per year and over all years, from one set of bitmaps per year."""
    lines = table(spark, folder, "lineitem").select(
        F.year("l_shipdate").alias("ano"), F.col("l_suppkey").alias("ies"), F.col("l_partkey").alias("cursos")
    )
    yearly = stats.code_bitmaps(lines, ["ies", "cursos"], ["ano"])
    whole = stats.bitmap_counts(yearly).select(F.lit(None).cast("int").alias("ano"), "*")
    return stats.bitmap_counts(yearly, ["ano"]).unionByName(whole)
