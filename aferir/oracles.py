"""The same results as plain SQL over the same tables, for queries SQL can express."""

from __future__ import annotations

STATS = """
stats AS (
  SELECT co_curso, co_grupo, ano,
         CAST(count(*) AS INTEGER) AS qt_inscritos,
         CAST(count(*) FILTER (WHERE presente) AS INTEGER) AS qt_presentes,
         avg(nota) FILTER (WHERE presente) AS media,
         median(nota) FILTER (WHERE presente) AS mediana,
         stddev_samp(nota) FILTER (WHERE presente) AS dp
  FROM (SELECT l_suppkey AS co_curso, l_returnflag AS co_grupo,
               CAST(year(l_shipdate) AS INTEGER) AS ano, l_linestatus = 'F' AS presente,
               CAST(round(l_extendedprice * 100) AS DOUBLE) AS nota
        FROM lineitem)
  GROUP BY ALL)
"""

DRIFT = """
drift AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, o_orderkey, o_custkey, o_orderstatus,
         CAST(NULL AS DOUBLE) AS vl_total
  FROM orders WHERE coalesce(o_orderdate < TIMESTAMP '1998-01-01', TRUE)
  UNION ALL
  SELECT CAST(year(o_orderdate) AS INTEGER), o_orderkey, o_custkey, NULL, o_totalprice
  FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
"""

CASCADE = """
base AS (SELECT DISTINCT l_suppkey AS co_ies, l_partkey AS co_area, l_returnflag AS co_municipio
         FROM lineitem),
direto AS (SELECT l_suppkey, l_partkey, l_returnflag, min(l_orderkey) AS c FROM lineitem
           WHERE l_linestatus = 'F' GROUP BY 1, 2, 3 HAVING count(DISTINCT l_orderkey) = 1),
n1 AS (SELECT l_suppkey, l_partkey, min(l_orderkey) AS c FROM lineitem
       WHERE l_linestatus = 'O' GROUP BY 1, 2 HAVING count(DISTINCT l_orderkey) = 1),
n2 AS (SELECT l_suppkey, l_partkey, l_returnflag, min(l_orderkey) AS c FROM lineitem
       WHERE l_linestatus = 'O' GROUP BY 1, 2, 3 HAVING count(DISTINCT l_orderkey) = 1),
cascade AS (
  SELECT co_ies, co_area, co_municipio, coalesce(direto.c, n1.c, n2.c) AS co_curso
  FROM base
  LEFT JOIN direto ON direto.l_suppkey = co_ies AND direto.l_partkey = co_area
                  AND direto.l_returnflag = co_municipio
  LEFT JOIN n1 ON n1.l_suppkey = co_ies AND n1.l_partkey = co_area
  LEFT JOIN n2 ON n2.l_suppkey = co_ies AND n2.l_partkey = co_area
              AND n2.l_returnflag = co_municipio)
"""

GRADED = """
graded AS (
  SELECT o_orderkey,
         CASE o_orderpriority WHEN '5-LOW' THEN ' SC ' WHEN '4-NOT SPECIFIED' THEN NULL
              ELSE substr(o_orderpriority, 1, 1) END AS faixa,
         CASE o_orderstatus WHEN 'P' THEN 'sem conceito' WHEN 'O' THEN '  ' END AS observacao,
         CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS continuo,
         o_totalprice AS bruta
  FROM orders),
flagged AS (
  SELECT *, trim(faixa) = 'SC'
            OR ((faixa IS NULL OR trim(faixa) IN ('', 'None'))
                AND observacao IS NOT NULL AND trim(observacao) NOT IN ('', 'None')) AS sem
  FROM graded)
"""

SHARES = """
contagem AS (SELECT dia, user_id, questao, resposta, count(*) AS n FROM respostas
             WHERE resposta IS NOT NULL GROUP BY ALL),
resp AS (SELECT dia, user_id, questao, sum(n) AS total FROM contagem GROUP BY ALL),
visto AS (SELECT DISTINCT dia, questao, resposta FROM contagem),
partes AS (
  SELECT resp.dia, resp.user_id, resp.questao, visto.resposta, resp.total,
         coalesce(c.n, 0) / resp.total AS parte
  FROM resp JOIN visto ON visto.dia = resp.dia AND visto.questao = resp.questao
  LEFT JOIN contagem c ON c.dia = resp.dia AND c.user_id = resp.user_id
       AND c.questao = resp.questao AND c.resposta = visto.resposta)
"""


def share_columns(question: str, answers: list[str]) -> str:
    picked = [
        f"max(parte) FILTER (WHERE questao = '{question}' AND resposta = '{a}') AS {question}_{a}"
        for a in answers
    ]
    total = f"CAST(max(total) FILTER (WHERE questao = '{question}') AS BIGINT) AS {question}_respondentes"
    return ", ".join([total, *picked])


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


# The difference sheet: flag, hidden grades, repaired outliers, year filled from the same sheet.
IDD = f"""
{GRADED},
rows AS (
  SELECT o.o_custkey AS co_ies, o.o_orderkey % 7 AS co_curso, CAST(year(o_orderdate) AS INTEGER) AS ano_fonte,
         o.o_orderkey AS _linha, faixa, CASE WHEN year(o_orderdate) = 1998 THEN FALSE ELSE sem END AS s,
         CASE WHEN o_orderstatus <> 'F' THEN round(o_totalprice * 100) END AS continuo_c,
         round(o_totalprice * 100) AS bruta_c,
         CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS in_cebas
  FROM orders o JOIN flagged f ON o.o_orderkey = f.o_orderkey),
typed AS (
  SELECT *, CASE WHEN s THEN NULL ELSE TRY_CAST(faixa AS INTEGER) END AS idd_faixa,
         CASE WHEN s THEN NULL ELSE continuo_c END AS c1, CASE WHEN s THEN NULL ELSE bruta_c END AS nota_bruta_idd
  FROM rows),
known AS (SELECT DISTINCT ano_fonte AS known_year FROM rows WHERE _linha % 100 = 1),
idd AS (
  SELECT co_ies, co_curso, known_year AS ano, idd_faixa,
         CASE WHEN nota_bruta_idd IS NOT NULL AND c1 IS NULL AND idd_faixa = 1 AND NOT s THEN 0.0 ELSE c1 END AS idd_continuo,
         nota_bruta_idd, in_cebas, CAST(ano_fonte AS VARCHAR) AS fonte, ano_fonte, _linha, s AS in_sem_conceito
  FROM typed LEFT JOIN known ON ano_fonte = known_year)
"""

IGC = """
  SELECT o_custkey AS co_ies, CAST(year(o_orderdate) AS INTEGER) AS ano, round(o_totalprice * 100) AS igc_continuo,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS igc_faixa,
         CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS INTEGER) AS in_cebas,
         CAST(year(o_orderdate) AS INTEGER) AS ano_fonte, o_orderkey AS _linha
  FROM orders
"""

CENSUS = """
  SELECT *, CASE tp_categoria_adm WHEN 1 THEN 'Pública Federal' WHEN 2 THEN 'Pública Estadual'
                 WHEN 3 THEN 'Pública Municipal' WHEN 4 THEN 'Privada com fins lucrativos'
                 WHEN 5 THEN 'Privada sem fins lucrativos' END AS categoria_adm,
         CASE tp_org_academica WHEN 1 THEN 'Universidade' WHEN 4 THEN 'Instituto Federal de Educação, Ciência e Tecnologia' END AS org_academica,
         CASE tp_rede WHEN 1 THEN 'Pública' WHEN 2 THEN 'Privada' END AS rede
  FROM (SELECT *, CASE WHEN ano < 1998 THEN CAST(CASE WHEN tp_categoria_adm <= 3 THEN 1 ELSE 2 END AS INTEGER) END AS tp_rede
        FROM (SELECT o_custkey, o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS ano, o_orderpriority AS no_ies,
                     CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS tp_categoria_adm, o_orderstatus AS sg_uf,
                     CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 4 END AS INTEGER) AS tp_org_academica
              FROM orders))
"""

ORACLES: dict[str, str] = {
    "q01_typed_projection": """
        SELECT CAST(l_orderkey AS BIGINT) AS co_curso, CAST(l_suppkey AS INTEGER) AS co_ies,
               CAST(l_linenumber AS BIGINT) AS nu_item, CAST(l_quantity AS INTEGER) AS qt_itens,
               l_extendedprice AS vl_bruto, l_returnflag AS sg_retorno
        FROM lineitem""",
    "q02_lenient_cast": """
        SELECT p_partkey, TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER) AS nu_marca,
               TRY_CAST(p_type AS INTEGER) AS nu_tipo, CAST(p_size AS INTEGER) AS nu_tamanho
        FROM part""",
    "q03_null_tokens": """
        SELECT o_orderkey,
               CASE WHEN o_orderpriority NOT IN ('', 'NA', 'N/A', 'nan', '4-NOT SPECIFIED')
                    THEN o_orderpriority END AS prioridade
        FROM orders""",
    "q04_diagonal_union": f"WITH {DRIFT} SELECT * FROM drift",
    "q05_keep_first": """
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
               l_discount, l_tax, l_returnflag, l_linestatus
        FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
                   l_returnflag, l_linestatus) = 1""",
    "q06_decode_labels": """
        SELECT o_orderkey, o_orderstatus,
               CASE o_orderstatus WHEN 'F' THEN 'Fechado' WHEN 'O' THEN 'Aberto' END AS situacao
        FROM orders""",
    "q07_history": """
        SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS ano, o_orderkey, o_orderstatus,
               CASE o_orderstatus WHEN 'F' THEN 'Fechado' WHEN 'O' THEN 'Aberto' END AS situacao
        FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey, year(o_orderdate)
                                   ORDER BY o_orderdate, o_orderkey) = 1""",
    "q08_latest_dim": """
        SELECT c_custkey, c_nationkey, c_mktsegment, ano_referencia, o_orderstatus AS o_orderstatus_atual,
               o_orderpriority AS o_orderpriority_atual, o_totalprice AS o_totalprice_atual
        FROM customer LEFT JOIN (
          SELECT *, CAST(year(o_orderdate) AS INTEGER) AS ano_referencia FROM orders
          QUALIFY row_number() OVER (PARTITION BY o_custkey
                    ORDER BY year(o_orderdate) DESC, o_orderdate, o_orderkey) = 1)
          ON o_custkey = c_custkey""",
    "q09_threshold_flag": """
        SELECT p_partkey, nullif(p_size, 50) AS tp_categoria,
               CASE WHEN nullif(p_size, 50) <= 3 THEN 1 ELSE 2 END AS tp_rede
        FROM part""",
    "q10_unambiguous_lookup": """
        SELECT o_custkey, o_orderpriority, min(o_orderkey) AS co_pedido FROM orders
        GROUP BY 1, 2 HAVING count(DISTINCT o_orderkey) = 1""",
    "q11_cascade_enrich": f"WITH {CASCADE} SELECT * FROM cascade",
    "q12_sentinel": f"""
        WITH {CASCADE}
        SELECT co_municipio, count(*) AS linhas, count(*) FILTER (WHERE co_curso IS NULL) AS sem_curso,
               count(DISTINCT co_curso) AS cursos
        FROM cascade GROUP BY 1""",
    "q13_lookup_join": """
        SELECT l_partkey AS co_curso, l_orderkey, l_linenumber, l_quantity, p_size AS co_ies, p_brand
        FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size <> 50""",
    "q14_score_stats": f"""
        WITH {STATS}
        SELECT co_curso, co_grupo, ano, qt_inscritos, qt_presentes, media / 100 AS nt_ger_media,
               mediana / 100 AS nt_ger_mediana, round(dp / 100, 4) AS nt_ger_dp
        FROM stats""",
    "q15_participation": f"""
        WITH {STATS}
        SELECT co_curso, co_grupo, ano, qt_inscritos, qt_presentes,
               CAST(qt_presentes AS DOUBLE) / qt_inscritos AS tx_participacao
        FROM stats""",
    "q16_group_percentile": f"""
        WITH {STATS}, ranked AS (
          SELECT *, count(media) OVER (PARTITION BY co_grupo, ano) AS n,
                 CASE WHEN media IS NOT NULL THEN row_number() OVER (
                   PARTITION BY co_grupo, ano ORDER BY media ASC NULLS LAST, co_curso) END AS r
          FROM stats)
        SELECT co_curso, co_grupo, ano, qt_inscritos, qt_presentes, media / 100 AS nt_ger_media,
               mediana / 100 AS nt_ger_mediana, round(dp / 100, 4) AS nt_ger_dp,
               CAST(qt_presentes AS DOUBLE) / qt_inscritos AS tx_participacao,
               CASE WHEN n > 1 THEN round_even(CAST(r - 1 AS DOUBLE) / (n - 1) * 100, 1)
                    ELSE 50.0 END AS percentil_grupo
        FROM ranked""",
    "q17_answer_distribution": f"""
        WITH respostas AS (SELECT 0 AS dia, user_id, 'qe_i01' AS questao, event_type AS resposta
                           FROM events), {SHARES}
        SELECT user_id, {share_columns("qe_i01", EVENT_TYPES)} FROM partes GROUP BY user_id""",
    "q18_profile_wide": f"""
        WITH ev AS (SELECT CAST(day(ts) AS INTEGER) AS dia, user_id, event_type,
                           CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events),
        respostas AS (
          SELECT dia, user_id, 'qe_i01' AS questao, event_type AS resposta FROM ev
          UNION ALL
          SELECT dia, user_id, 'qe_i02', CASE WHEN k < 30 THEN 'A' WHEN k < 60 THEN 'B' END FROM ev),
        {SHARES}
        SELECT dia, user_id, {share_columns("qe_i01", EVENT_TYPES)}, {share_columns("qe_i02", ["A", "B"])}
        FROM partes GROUP BY dia, user_id""",
    "q19_no_grade_flag": f"""
        WITH {GRADED}
        SELECT o_orderkey, sem AS in_sem_conceito,
               CASE WHEN sem THEN NULL ELSE faixa END AS idd_faixa,
               CASE WHEN sem THEN NULL ELSE continuo END AS idd_continuo,
               CASE WHEN sem THEN NULL ELSE bruta END AS nota_bruta_idd
        FROM flagged""",
    "q20_outlier_repair": f"""
        WITH {GRADED}
        SELECT o_orderkey, CASE WHEN sem THEN NULL ELSE TRY_CAST(faixa AS INTEGER) END AS idd_faixa,
               CASE WHEN sem THEN NULL
                    WHEN continuo IS NULL AND faixa = '1' AND NOT sem THEN 0.0
                    ELSE continuo END AS idd_continuo
        FROM flagged""",
    "q21_year_fill": """
        WITH s AS (SELECT o_orderpriority AS fonte, o_orderkey,
                          CASE WHEN o_orderstatus = 'F' THEN CAST(year(o_orderdate) AS INTEGER) END AS a
                   FROM orders),
        f AS (SELECT fonte, arg_min(a, o_orderkey) AS a1 FROM s WHERE a IS NOT NULL GROUP BY 1)
        SELECT s.fonte, coalesce(a, a1) AS ano, count(*) AS linhas
        FROM s LEFT JOIN f ON f.fonte = s.fonte GROUP BY 1, 2""",
    "q22_cebas": """
        WITH t AS (SELECT CASE WHEN l_returnflag = 'N' THEN '-'
                               WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'X'
                               WHEN l_returnflag = 'A' THEN 'Sim'
                               WHEN l_linestatus = 'O' THEN 'outro' END AS texto FROM lineitem)
        SELECT texto, CASE texto WHEN 'X' THEN TRUE WHEN '-' THEN FALSE END AS in_cebas,
               CASE WHEN texto IN ('Sim', 'SIM', 'sim', '1') THEN 1
                    WHEN texto IN ('-', 'Não', 'NÃO', 'não', '0', '') THEN 0 END AS co_cebas,
               count(*) AS linhas
        FROM t GROUP BY 1, 2, 3""",
    "q23_canonical_columns": """
        SELECT c_custkey AS co_ies, c_name AS no_ies, c_nationkey AS co_area, c_acctbal AS saldo
        FROM customer""",
    "q24_footer_filter": """
        SELECT CAST(c_custkey AS VARCHAR) AS co_ies, c_mktsegment AS no_ies
        FROM customer WHERE c_nationkey > 2""",
    "q25_dq_report": """
        WITH v AS (
          SELECT unnest(['not_empty', 'no_nulls:l_orderkey', 'no_nulls:l_linenumber',
                         'in_range:l_discount', 'in_range:l_quantity',
                         'row_rule:imposto_ate_desconto']) AS "check",
                 unnest([CAST(count(*) = 0 AS BIGINT), count(*) FILTER (WHERE l_orderkey IS NULL),
                         count(*) FILTER (WHERE l_linenumber IS NULL),
                         count(*) FILTER (WHERE l_discount < 0 OR l_discount > CAST(0.05 AS DOUBLE)),
                         count(*) FILTER (WHERE l_quantity < 1 OR l_quantity > 50),
                         count(*) FILTER (WHERE NOT l_tax <= l_discount)]) AS violations
          FROM lineitem)
        SELECT *, violations = 0 AS ok FROM v""",
    "q26_pk_report": """
        SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
        GROUP BY 1, 2 HAVING count(*) > 1""",
    "q27_fk_orphans": """
        WITH k AS (SELECT DISTINCT o_custkey FROM orders),
        c AS (SELECT count(*) AS chaves,
                     count(*) FILTER (WHERE o_custkey NOT IN (
                       SELECT c_custkey FROM customer WHERE c_acctbal >= 0)) AS orfas FROM k)
        SELECT chaves, orfas, CAST(orfas AS DOUBLE) / chaves * 100 AS pct,
               orfas * 100 < chaves * 10 AS ok FROM c""",
    "q28_reconcile": """
        WITH l AS (SELECT l_orderkey, sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS soma
                   FROM lineitem GROUP BY 1),
        d AS (SELECT abs(CAST(round(o_totalprice * 100) AS BIGINT) - soma) AS dif
              FROM orders JOIN l ON l_orderkey = o_orderkey)
        SELECT count(*) AS n, avg(dif) AS media_dif, CAST(max(dif) AS BIGINT) AS max_dif,
               avg(dif) < 5000000 AND max(dif) < 100000000 AS ok FROM d""",
    "q29_layer_totals": f"""
        WITH {STATS}
        SELECT CAST((SELECT sum(qt_presentes) FROM stats) AS BIGINT) AS total_gold, count(*) AS total_silver,
               (SELECT sum(qt_presentes) FROM stats) = count(*) AS ok
        FROM lineitem WHERE l_linestatus = 'F'""",
    "q30_year_summary": f"""
        WITH {STATS}
        SELECT ano, round(avg(media) / 100, 4) AS media_geral,
               CAST(sum(qt_presentes) AS BIGINT) AS total_presentes, count(*) AS cursos
        FROM stats WHERE qt_presentes > 0 GROUP BY ano ORDER BY ano""",
    "q31_build_summary": """
        SELECT count(*) AS linhas, count(DISTINCT l_suppkey) AS ies, count(DISTINCT l_partkey) AS cursos,
               (SELECT string_agg(CAST(y AS VARCHAR), ',' ORDER BY y)
                FROM (SELECT DISTINCT year(l_shipdate) AS y FROM lineitem)) AS anos,
               count(*) FILTER (WHERE l_returnflag = 'R') AS devolvidos,
               count(*) FILTER (WHERE l_linestatus <> 'F') AS nota_nulos,
               CAST(count(*) FILTER (WHERE l_linestatus = 'F') AS DOUBLE) / count(*) * 100
                 AS nota_preenchido_pct
        FROM lineitem""",
    "q32_schema_drift": f"""
        WITH {DRIFT}, h AS (
          SELECT DISTINCT ano, 'o_orderkey' AS coluna FROM drift WHERE o_orderkey IS NOT NULL
          UNION SELECT ano, 'o_custkey' FROM drift WHERE o_custkey IS NOT NULL
          UNION SELECT ano, 'o_orderstatus' FROM drift WHERE o_orderstatus IS NOT NULL
          UNION SELECT ano, 'vl_total' FROM drift WHERE vl_total IS NOT NULL)
        SELECT coluna, count(*) AS n_anos, string_agg(CAST(ano AS VARCHAR), ',' ORDER BY ano) AS anos
        FROM h GROUP BY 1""",
    "q33_stale_years": """
        WITH s AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, max(o_orderdate) AS m
                   FROM orders GROUP BY 1),
        o AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, max(l_shipdate) AS m FROM lineitem
              WHERE l_returnflag = 'A' AND year(l_shipdate) <> 1997 GROUP BY 1)
        SELECT s.ano FROM s LEFT JOIN o ON o.ano = s.ano WHERE o.m IS NULL OR s.m > o.m""",
    "q34_year_spec": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, count(*) AS pedidos,
               CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 AS total
        FROM orders WHERE year(o_orderdate) IN (1995, 1997, 1999) GROUP BY 1""",
    "q35_header_promotion": """
        SELECT c_nationkey AS fonte, c_custkey AS co_ies, c_mktsegment AS no_segmento,
               CASE WHEN c_nationkey >= 12 THEN CAST(round(c_acctbal) AS BIGINT) END AS vl_saldo
        FROM customer""",
    "q36_coverage": f"""
        WITH {DRIFT},
        w AS (SELECT * FROM (VALUES (1995, TRUE), (1996, TRUE), (1997, TRUE), (1998, TRUE),
              (2000, TRUE), (2001, TRUE), (2002, TRUE), (1999, FALSE)) t(ano, esperado)),
        p AS (SELECT ano, count(*) AS linhas,
                     count(*) FILTER (WHERE ano >= 1998 AND vl_total IS NULL) AS sem_total
              FROM drift GROUP BY 1)
        SELECT coalesce(w.ano, p.ano) AS ano, coalesce(esperado, FALSE) AS esperado,
               coalesce(linhas, 0) AS linhas,
               coalesce(esperado, FALSE) = (coalesce(linhas, 0) > 0) AS ok,
               coalesce(sem_total, 0) AS sem_total
        FROM w FULL JOIN p ON p.ano = w.ano""",
    "q37_preview": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 5""",
    "q38_gold_fallback_flag": f"""
        WITH {GRADED}
        SELECT o_orderkey, faixa AS idd_faixa,
               faixa IS NULL OR (observacao IS NOT NULL AND trim(observacao) NOT IN ('', 'None'))
                 AS in_sem_conceito
        FROM graded""",
    "q39_code_lookup": """
        SELECT DISTINCT l_suppkey AS co_ies, l_partkey AS co_grupo,
               CAST(l_linenumber AS BIGINT) AS co_munic_curso
        FROM lineitem WHERE l_returnflag <> 'N'""",
    "q40_value_range": """
        WITH c AS (SELECT CAST(round(c_acctbal * 100) AS BIGINT) AS saldo, c_nationkey FROM customer)
        SELECT 'saldo' AS coluna, CAST(min(saldo) AS DOUBLE) AS minimo, CAST(max(saldo) AS DOUBLE) AS maximo,
               avg(saldo) AS media, CAST(max(abs(saldo)) AS DOUBLE) AS max_abs FROM c
        UNION ALL
        SELECT 'c_nationkey', min(c_nationkey), max(c_nationkey), avg(c_nationkey), max(abs(c_nationkey))
        FROM c""",
    "q41_orphan_keys": """
        SELECT DISTINCT l_partkey AS p_partkey FROM lineitem
        WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 40)""",
    "q42_pk_summary": """
        WITH g AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
        SELECT CAST(sum(n) AS BIGINT) AS linhas, count(*) AS chaves,
               CAST(sum(n) - count(*) AS BIGINT) AS duplicatas, sum(n) = count(*) AS ok FROM g""",
    "q43_hot_group_median": """
        SELECT l_returnflag, median(CAST(round(l_extendedprice * 100) AS DOUBLE)) / 100 AS mediana
        FROM lineitem GROUP BY 1""",
    "q44_hot_group_rank": """
        SELECT o_orderstatus, o_orderkey,
               CAST(row_number() OVER (PARTITION BY o_orderstatus
                 ORDER BY round(o_totalprice * 100), o_orderkey) AS INTEGER) AS posicao
        FROM orders""",
    "q45_rename_keep": """
        SELECT s_suppkey AS co_ies, s_name AS no_ies, s_nationkey, s_acctbal,
               CAST(NULL AS BIGINT) AS co_area, 2023 AS ano
        FROM supplier""",
    "q46_profile_long": """
        WITH ev AS (SELECT CAST(day(ts) AS INTEGER) AS dia, user_id, event_type,
                           CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events),
        respostas AS (
          SELECT dia, user_id, 'qe_i01' AS questao, event_type AS resposta FROM ev
          UNION ALL
          SELECT dia, user_id, 'qe_i02', CASE WHEN k < 30 THEN 'A' WHEN k < 60 THEN 'B' END FROM ev),
        c AS (SELECT dia, user_id, questao, resposta, count(*) AS n FROM respostas
              WHERE resposta IS NOT NULL GROUP BY ALL)
        SELECT *, CAST(sum(n) OVER (PARTITION BY dia, user_id, questao) AS BIGINT) AS respondentes,
               round(n / sum(n) OVER (PARTITION BY dia, user_id, questao), 9) AS parte FROM c""",
    "q47_fact_cpc": """
        SELECT l_suppkey AS co_ies, l_partkey AS co_area, CAST(year(l_shipdate) AS INTEGER) AS ano,
               CASE WHEN l_returnflag <> 'N' THEN l_orderkey ELSE -1 END AS co_curso,
               CAST(round(l_extendedprice * 100) AS BIGINT) AS cpc_continuo
        FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_partkey, year(l_shipdate)
                                   ORDER BY l_orderkey * 10 + l_linenumber) = 1""",
    "q48_clean_idd": f"""
        WITH {IDD}
        SELECT co_ies, co_curso, ano, idd_faixa, idd_continuo, nota_bruta_idd, in_cebas, fonte, ano_fonte, _linha,
               in_sem_conceito FROM idd""",
    "q49_fact_idd": f"""
        WITH {IDD}
        SELECT co_ies, co_curso, ano, idd_faixa, idd_continuo, nota_bruta_idd, in_cebas, in_sem_conceito FROM idd
        QUALIFY row_number() OVER (PARTITION BY co_ies, co_curso, ano ORDER BY ano_fonte, _linha) = 1""",
    "q50_clean_igc": f"SELECT * FROM ({IGC})",
    "q51_fact_igc": f"""
        SELECT co_ies, ano, igc_continuo, igc_faixa, in_cebas FROM ({IGC})
        QUALIFY row_number() OVER (PARTITION BY co_ies, ano ORDER BY ano_fonte, _linha) = 1""",
    "q52_history": f"""
        SELECT o_custkey AS co_ies, ano, no_ies, tp_categoria_adm, tp_org_academica, tp_rede, categoria_adm,
               org_academica, rede FROM ({CENSUS})
        QUALIFY row_number() OVER (PARTITION BY o_custkey, ano ORDER BY o_orderkey) = 1""",
    "q53_latest_institutions": f"""
        SELECT o_custkey AS co_ies, ano AS ano_referencia, sg_uf, no_ies AS no_ies_atual,
               tp_categoria_adm AS tp_categoria_adm_atual, tp_org_academica AS tp_org_academica_atual,
               tp_rede AS tp_rede_atual, categoria_adm AS categoria_adm_atual,
               org_academica AS org_academica_atual, rede AS rede_atual FROM ({CENSUS})
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY ano DESC, o_orderkey) = 1""",
    "q54_one_per_course": """
        SELECT l_suppkey AS co_ies, l_partkey AS co_area, CAST(year(l_shipdate) AS INTEGER) AS ano,
               CASE WHEN l_returnflag <> 'N' THEN l_orderkey END AS co_curso,
               CAST(round(l_extendedprice * 100) AS BIGINT) AS cpc_continuo,
               CAST(NULL AS VARCHAR) AS "Coluna Solta"
        FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_suppkey, year(l_shipdate)
                                   ORDER BY l_partkey, l_orderkey * 10 + l_linenumber) = 1""",
    "q55_student_rows": """
        SELECT CAST(year(l_shipdate) AS INTEGER) AS ano_fonte, CAST(year(l_shipdate) AS INTEGER) AS ano,
               l_partkey AS co_curso, CAST(p_size AS BIGINT) AS co_ies, CAST(p_size AS INTEGER) AS co_grupo,
               CAST(CAST(l_quantity AS INTEGER) AS FLOAT) AS nt_ger, CAST(l_linenumber AS INTEGER) AS tp_pres
        FROM lineitem JOIN part ON l_partkey = p_partkey
        WHERE l_linenumber <> 7 AND p_size <> 50""",
    "q56_required_columns": """
        SELECT * FROM (VALUES ('required:l_orderkey', TRUE), ('required:l_ausente', FALSE),
                              ('type:l_orderkey:bigint', TRUE), ('type:l_quantity:int', FALSE),
                              ('type:l_ausente:int', FALSE)) AS t("check", ok)""",
    "q57_identified_only": """
        SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, count(*) AS linhas, count(DISTINCT l_orderkey) AS cursos
        FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1""",
    "q58_inferred_types": r"""
        WITH t AS (
          SELECT CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(o_orderkey AS VARCHAR) AS chave,
                 CAST(o_custkey * 10000000 AS VARCHAR) AS grande, CAST(o_totalprice AS VARCHAR) AS preco,
                 CASE WHEN year(o_orderdate) % 2 = 1 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR)
                      ELSE o_orderpriority END AS misto,
                 CASE WHEN o_orderstatus = 'P' THEN 'NA' END AS vazia
          FROM orders),
        v AS (
          SELECT ano, 'chave' AS coluna, chave AS v FROM t UNION ALL SELECT ano, 'grande', grande FROM t
          UNION ALL SELECT ano, 'preco', preco FROM t UNION ALL SELECT ano, 'misto', misto FROM t
          UNION ALL SELECT ano, 'vazia', vazia FROM t),
        k AS (SELECT ano, coluna, CASE WHEN v NOT IN ('', 'NA', 'N/A', 'nan') THEN v END AS v FROM v)
        SELECT ano, coluna,
               CAST(max(CASE WHEN v IS NULL THEN NULL
                             WHEN regexp_matches(v, '^[+-]?[0-9]+$') AND TRY_CAST(v AS INTEGER) IS NOT NULL THEN 0
                             WHEN regexp_matches(v, '^[+-]?[0-9]+$') AND TRY_CAST(v AS BIGINT) IS NOT NULL THEN 1
                             WHEN regexp_matches(v, '^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$') THEN 2
                             ELSE 3 END) AS INTEGER) AS ordem,
               count(v) AS preenchidos
        FROM k GROUP BY ano, coluna""",
    "q59_bitmap_counts": """
        WITH v AS (
          SELECT CAST(year(l_shipdate) AS INTEGER) AS ano, 'ies' AS coluna, l_suppkey AS c FROM lineitem
          UNION ALL SELECT CAST(year(l_shipdate) AS INTEGER), 'cursos', l_partkey FROM lineitem)
        SELECT ano, coluna, CAST(count(DISTINCT c) AS BIGINT) AS distintos FROM v GROUP BY ano, coluna
        UNION ALL SELECT NULL, coluna, CAST(count(DISTINCT c) AS BIGINT) FROM v GROUP BY coluna""",
}
