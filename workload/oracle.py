"""SQL counterparts of the registered queries, written from the definitions.

They share nothing with the Spark code: quartiles come from ``quantile_cont``, the wide-to-
long step from a cross join with the years, keep-first from a window.
"""

from __future__ import annotations

from edupanel import config as C
from workload.registry import CHANGED_YEAR, FIRST_YEAR, NAME_QUERY, STATES, TEXT_QUERY, YEAR

# --- tables -------------------------------------------------------------------------------

def projects(where: str) -> str:
    return f"""
        SELECT upper(c_name) AS nome_municipio_formatado, n_name AS sg_uf,
               CAST(year(o_orderdate) AS INTEGER) AS ano,
               CAST(count(DISTINCT o_orderkey) AS DOUBLE) AS nr_projetos,
               CAST(count(l_orderkey) AS DOUBLE) AS nr_instituicoes,
               coalesce(sum(l_quantity), 0.0) AS nr_beneficiados,
               CASE WHEN n_nationkey < 20 THEN n_name END AS nome_uf
        FROM orders
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        LEFT JOIN lineitem ON l_orderkey = o_orderkey
        WHERE {where}
        GROUP BY c_name, n_name, n_nationkey, year(o_orderdate)"""


def distortion(where: str) -> str:
    return f"""
        SELECT o_custkey AS id_municipio, CAST(year(o_orderdate) AS INTEGER) AS ano,
               'MUNICIPIO No ' || o_custkey AS nome_municipio_formatado,
               avg(total) AS taxa_distorcao_total_fun,
               avg(early) AS taxa_distorcao_anos_iniciais,
               avg(late) AS taxa_distorcao_anos_finais
        FROM (SELECT l_orderkey, round(max(l_discount) * 100) AS total,
                     round(max(l_tax) * 100) AS early, max(l_quantity) AS late
              FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
        JOIN orders ON l_orderkey = o_orderkey
        WHERE {where}
        GROUP BY o_custkey, year(o_orderdate)"""


CTES = {
    "gdp_base": ("""
        SELECT CAST(o.ano AS INTEGER) AS ano, r_name AS regiao, c_custkey AS id_municipio,
               n_name AS sg_uf, o.total AS pib_mil_reais, c_acctbal AS pib_per_capita,
               upper(c_name) AS nome_municipio_formatado,
               (o.total * 1000) / c_acctbal AS populacao
        FROM (SELECT o_custkey, year(o_orderdate) AS ano,
                     CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
              FROM orders GROUP BY 1, 2) o
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        WHERE c_acctbal > 0""", []),
    "gdp": ("""
        SELECT * FROM gdp_base
        UNION ALL
        SELECT CAST(y.ano AS INTEGER), g.* EXCLUDE (ano)
        FROM gdp_base g, (VALUES (2002), (2003), (2004), (2005)) y(ano)
        WHERE g.ano = (SELECT max(ano) FROM gdp_base)""", ["gdp_base"]),
    "score_best": ("""
        SELECT o_custkey, year(o_orderdate) AS ano, o_orderstatus, max(o_totalprice) AS best
        FROM orders WHERE year(o_orderdate) IN (1995, 1997, 1999, 2001)
        GROUP BY 1, 2, 3""", []),
    "score": ("""
        SELECT k.o_custkey AS id_municipio, b.best AS ideb_nota, CAST(y.ano AS INTEGER) AS ano,
               'MUNICIPIO No ' || k.o_custkey AS nome_municipio_formatado
        FROM (SELECT DISTINCT o_custkey FROM score_best WHERE o_orderstatus = 'F') k
        CROSS JOIN (VALUES (1995), (1997), (1999), (2001)) y(ano)
        LEFT JOIN score_best b
          ON b.o_custkey = k.o_custkey AND b.ano = y.ano AND b.o_orderstatus = 'F'""",
        ["score_best"]),
    "projects": (projects("o_orderpriority = '1-URGENT'"), []),
    "all_projects": (projects("true"), []),
    "raw_territory": ("""
        SELECT c_custkey + 1000000000000000 AS _row, lower(c_mktsegment) AS nome_rgi, *
        EXCLUDE (_row, nome_rgi) FROM (
            SELECT 0 AS _row, '' AS nome_rgi, customer.*, nation.* FROM customer
            JOIN nation ON c_nationkey = n_nationkey)
        WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O')
        UNION ALL
        SELECT c_custkey, c_mktsegment, customer.*, nation.*
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        WHERE c_custkey IN (SELECT o_custkey FROM orders
                            WHERE o_orderstatus = 'O' AND o_orderpriority = '1-URGENT')""", []),
    "territory": ("""
        SELECT n_nationkey AS id_uf, n_name AS nome_uf, nome_rgi, c_custkey AS id_municipio,
               upper(c_name) AS nome_municipio_formatado, _row
        FROM raw_territory
        QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY _row) = 1""",
        ["raw_territory"]),
    "distortion": (distortion("year(o_orderdate) BETWEEN 1997 AND 2001"), []),
    "all_distortion": (distortion("true"), []),
    "panel": ("""
        SELECT g.ano, g.regiao, g.id_municipio, g.sg_uf, g.pib_mil_reais, g.pib_per_capita,
               g.nome_municipio_formatado, g.populacao, s.ideb_nota, t.id_uf, t.nome_uf,
               t.nome_rgi, p.nr_projetos, p.nr_instituicoes, p.nr_beneficiados,
               d.taxa_distorcao_total_fun, d.taxa_distorcao_anos_iniciais,
               d.taxa_distorcao_anos_finais
        FROM gdp g
        LEFT JOIN score s ON s.id_municipio = g.id_municipio AND s.ano = g.ano
        LEFT JOIN territory t ON t.id_municipio = g.id_municipio
        LEFT JOIN projects p
          ON p.nome_municipio_formatado = g.nome_municipio_formatado
         AND p.nome_uf IS NOT DISTINCT FROM t.nome_uf AND p.ano = g.ano
        LEFT JOIN distortion d ON d.id_municipio = g.id_municipio AND d.ano = g.ano""",
        ["gdp", "score", "territory", "projects", "distortion"]),
}


def quartile_case(column: str, results: list[str]) -> str:
    cases = " ".join(
        f"WHEN {column} <= (SELECT quantile_cont({column}, {q}) FROM panel) THEN {result}"
        for q, result in zip(("0.25", "0.5", "0.75"), results)
    )
    return f"CASE {cases} WHEN {column} IS NOT NULL THEN {results[3]} END"


def band(column: str, out: str, labels) -> str:
    label = quartile_case(column, [f"'{v}'" for v in labels])
    return f"{label} AS {out}, {quartile_case(column, ['1', '2', '3', '4'])} AS {out}_ord"


CTES["serving"] = (f"""
        SELECT * EXCLUDE (id_municipio, nr_projetos, nr_beneficiados),
               CAST(id_municipio AS VARCHAR) AS id_municipio,
               coalesce(nr_projetos, 0.0) AS nr_projetos,
               coalesce(nr_beneficiados, 0.0) AS nr_beneficiados,
               coalesce(nr_projetos, 0) > 0 AS tem_projeto,
               CASE WHEN nr_projetos > 0 THEN 'Com Projetos' ELSE 'Sem Projetos' END
                 AS status_projeto,
               {band('populacao', 'faixa_populacao', C.POPULATION_BANDS)},
               {band('pib_mil_reais', 'faixa_pib', C.GDP_BANDS)},
               {band('pib_per_capita', 'faixa_pib_per_capita', C.GDP_PER_CAPITA_BANDS)}
        FROM panel""", ["panel"])

CTES["explored"] = (f"""
        SELECT *, CASE WHEN nr_projetos IS NULL THEN 'Não' ELSE 'Sim' END AS tem_projeto_ia,
               {quartile_case('pib_per_capita', [f"'{v}'" for v in C.WEALTH_BANDS])}
                 AS categoria_pib,
               CASE WHEN populacao > 100000 THEN 'Grande' WHEN populacao > 20000 THEN 'Médio'
                    WHEN populacao <= 20000 THEN 'Pequeno' ELSE 'Não definido' END
                 AS porte_municipio
        FROM panel""", ["panel"])


def needed(name: str) -> list[str]:
    order: list[str] = []
    for part in CTES[name][1]:
        order += [n for n in needed(part) if n not in order]
    return [*order, name]


def sql(body: str, *tables: str) -> str:
    names: list[str] = []
    for table in tables:
        names += [n for n in needed(table) if n not in names]
    # each is computed once however often it is read
    parts = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n][0]})" for n in names)
    return f"WITH {parts}\n{body}" if parts else body


def r(value: str, digits: int = 4) -> str:
    scale = f"{10 ** digits}.0::DOUBLE"
    return f"round_even(({value}) * {scale}, 0) / {scale}"


def pairs(year: int) -> str:
    return f"ano = {year} AND sg_uf IS NOT NULL"


STATE_LIST = ", ".join(f"'{s}'" for s in STATES)
PANEL = ", ".join(C.PANEL_COLUMNS)
DETAIL = ", ".join(C.DETAIL_COLUMNS)
HOVER = ", ".join(f"s.{c}" for c in C.HOVER_COLUMNS)
NAME, RATE = "nome_municipio_formatado", "taxa_distorcao_total_fun"
DTYPES = {
    "ano": "int", "regiao": "string", "id_municipio": "bigint", "sg_uf": "string",
    "pib_mil_reais": "double", "pib_per_capita": "double", NAME: "string",
    "populacao": "double", "ideb_nota": "double", "id_uf": "int", "nome_uf": "string",
    "nome_rgi": "string", "nr_projetos": "double", "nr_instituicoes": "double",
    "nr_beneficiados": "double", RATE: "double", "taxa_distorcao_anos_iniciais": "double",
    "taxa_distorcao_anos_finais": "double",
}


def ranking(indicator: str, direction: str) -> str:
    other = RATE if indicator == "ideb_nota" else "ideb_nota"
    return sql(
        f"""SELECT {NAME}, {indicator}, {other} FROM serving
        WHERE {pairs(YEAR)} AND {indicator} IS NOT NULL
        ORDER BY {indicator} {direction}, {NAME}, id_municipio LIMIT 5""", "serving")


def band_query(column: str, out: str, labels) -> str:
    return sql(f"SELECT id_municipio, ano, {band(column, out, labels)} FROM panel", "panel")


def crosstab(value: str, keys: str, table: str, where: str) -> str:
    return sql(
        f"""SELECT {keys},
          {value.format("tem_projeto_ia = 'Não'")} AS "Não",
          {value.format("tem_projeto_ia = 'Sim'")} AS "Sim"
        FROM {table} WHERE {where} GROUP BY {keys}""", table)


OVERVIEW = f"""
    SELECT count(DISTINCT id_municipio) AS total_municipios,
           count(*) FILTER (status_projeto = 'Com Projetos') AS com_projetos,
           count(*) FILTER (status_projeto = 'Sem Projetos') AS sem_projetos,
           CAST(coalesce(sum(nr_projetos), 0) AS BIGINT) AS projetos_ativos,
           CAST(coalesce(sum(nr_beneficiados), 0) AS BIGINT) AS estudantes_beneficiados,
           avg(ideb_nota) AS ideb_medio, min(ideb_nota) AS ideb_min, max(ideb_nota) AS ideb_max
    FROM serving WHERE {pairs(YEAR)}"""

# what the folding has to do on the characters of the test texts
FOLD = r"""regexp_replace(strip_accents(translate(replace(trim(regexp_replace(replace(
    upper(replace(text, 'ß', 'ss')), 'MIXING CENTER', ''), '[-.!?"`()*]', '', 'g'),
    chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30)
    || chr(31) || ' ' || chr(133) || chr(160) || chr(8195) || chr(8201) || chr(8239)
    || chr(12288)), '  ', ' '), 'ªº' || chr(160), 'ao ')), '[^\x00-\x7F]', '', 'g')"""

ORACLE: dict[str, str] = {
    # sources
    "scan_header_offset": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "scan_multi_file": """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS ano,
        o_orderpriority FROM orders""",
    "scan_mixed_headers": """SELECT o_orderkey, o_totalprice, o_orderpriority, o_orderkey AS _row, fmt
        FROM orders, (VALUES ('csv'), ('parquet')) f(fmt)""",
    "scan_multi_sheet": """SELECT o_orderkey, o_totalprice,
        CAST(year(o_orderdate) AS INTEGER) AS ano FROM orders""",
    "scan_workbook": "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer",
    "scan_columns": """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_brand,
        p_partkey AS _row FROM part""",
    "na_tokens": """SELECT o_orderkey, CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN NULL
        WHEN '5-LOW' THEN NULL WHEN '3-MEDIUM' THEN ' - ' ELSE o_orderpriority END AS note
        FROM orders""",
    "parquet_roundtrip": """SELECT o_orderkey, o_custkey, o_totalprice,
        CAST(year(o_orderdate) AS INTEGER) AS ano FROM orders""",
    "geojson_features": sql("""SELECT CAST(t.id_municipio AS VARCHAR) AS id,
        '{"type":"Point","coordinates":[' || n_nationkey || ',' || n_regionkey || ']}'
        AS geometry FROM territory t JOIN nation ON t.id_uf = n_nationkey""", "territory"),
    "csv_export": sql(f"SELECT {DETAIL} FROM serving WHERE {pairs(YEAR)}", "serving"),
    "profile_panel": sql("\nUNION ALL ".join(
        f"""SELECT {n} AS position, '{c}' AS "column", '{DTYPES[c]}' AS dtype,
        count({c}) AS non_null, count(*) AS "rows" FROM panel"""
        for n, c in enumerate(C.PANEL_COLUMNS)), "panel"),
    "profile_observed": sql("\nUNION ALL ".join(
        f"""SELECT {n} AS position, '{c}' AS "column", '{DTYPES[c]}' AS dtype,
        count({c}) AS non_null, count(*) AS "rows",
        {'NULL' if DTYPES[c] == 'double' else f'CAST(min({c}) AS VARCHAR)'} AS low,
        {'NULL' if DTYPES[c] == 'double' else f'CAST(max({c}) AS VARCHAR)'} AS high FROM panel"""
        for n, c in enumerate(C.PANEL_COLUMNS)), "panel"),
    "cached_panel": sql(f"""SELECT ano, count(*) AS linhas, v.versao FROM panel, (VALUES (1), (2)) v(versao)
        WHERE ano < {YEAR} OR (ano = {YEAR} AND v.versao = 2) GROUP BY ano, v.versao""", "panel"),
    # projections and filters
    "rename_map": """SELECT CAST(o.ano AS INTEGER) AS ano, r_name AS regiao,
        CAST(c_custkey AS VARCHAR) AS id_municipio, c_name AS nome_municipio, n_name AS sg_uf,
        o.total AS pib_mil_reais,
        CASE WHEN c_acctbal > 0 THEN CAST(c_acctbal AS VARCHAR) ELSE '-' END AS pib_per_capita
        FROM (SELECT o_custkey, year(o_orderdate) AS ano,
                     CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
              FROM orders GROUP BY 1, 2) o
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "filter_network": sql("""SELECT o_custkey AS CO_MUNICIPIO,
        'Município nº ' || o_custkey AS NO_MUNICIPIO, 'Pública' AS REDE,
        max(best) FILTER (ano = 1995) AS VL_OBSERVADO_1995,
        max(best) FILTER (ano = 1997) AS VL_OBSERVADO_1997,
        max(best) FILTER (ano = 1999) AS VL_OBSERVADO_1999,
        max(best) FILTER (ano = 2001) AS VL_OBSERVADO_2001
        FROM score_best WHERE o_orderstatus = 'F' GROUP BY o_custkey""", "score_best"),
    "dropna_subset": sql(f"""SELECT id_municipio, ano, ideb_nota, {RATE} FROM panel
        WHERE ideb_nota IS NOT NULL AND {RATE} IS NOT NULL""", "panel"),
    "filter_year_state": sql(f"""SELECT {PANEL} FROM panel
        WHERE ano = {YEAR} AND sg_uf IN ({STATE_LIST})""", "panel"),
    "search_name": f"""SELECT doc_id FROM documents
        WHERE regexp_matches(text, '{TEXT_QUERY}', 'i')""",
    "cast_keys": """SELECT o_orderkey, o_custkey AS id_municipio,
        CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(o_custkey AS VARCHAR) AS id_texto
        FROM orders""",
    "coerce_numeric": """SELECT c_custkey, CASE c_mktsegment WHEN 'FURNITURE' THEN NULL
        WHEN 'MACHINERY' THEN NULL
        WHEN 'HOUSEHOLD' THEN CAST(CAST(c_acctbal AS VARCHAR) || 'e2' AS DOUBLE)
        ELSE c_acctbal END AS valor FROM customer""",
    "derive_population": """SELECT c_custkey,
        CASE WHEN total IS NULL THEN NULL WHEN c_acctbal > 0 THEN (total * 1000) / c_acctbal
             ELSE CAST('inf' AS DOUBLE) END AS populacao
        FROM customer LEFT JOIN (
            SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
            FROM orders GROUP BY 1) ON o_custkey = c_custkey""",
    "project_flags": sql("""SELECT CAST(id_municipio AS BIGINT) AS id_municipio, ano,
        nr_projetos, nr_instituicoes, nr_beneficiados, tem_projeto, status_projeto
        FROM serving""", "serving"),
    "project_flag_presence": sql(
        "SELECT id_municipio, ano, tem_projeto_ia FROM explored", "explored"),
    "map_lookup": """SELECT c_custkey, CASE WHEN n_nationkey < 20 THEN n_name END AS nome_uf
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "band_fixed": sql("SELECT id_municipio, ano, porte_municipio FROM explored", "explored"),
    "round_half_even": f"""SELECT l_orderkey, l_linenumber,
        {r('l_extendedprice * (1 - l_discount)', 2)} AS valor FROM lineitem""",
    "normalize_name": f"SELECT doc_id, {FOLD} AS nome FROM documents",
    # quartile bands
    "band_quartile_population": band_query("populacao", "faixa_populacao", C.POPULATION_BANDS),
    "band_quartile_gdp": band_query("pib_mil_reais", "faixa_pib", C.GDP_BANDS),
    "band_quartile_gdp_pc": band_query(
        "pib_per_capita", "faixa_pib_per_capita", C.GDP_PER_CAPITA_BANDS),
    "band_quartile_by_year": sql(f"""SELECT id_municipio, ano,
        list_extract([{", ".join(f"'{v}'" for v in C.POPULATION_BANDS)}], k) AS faixa_populacao,
        CAST(k AS INTEGER) AS faixa_populacao_ord
        FROM (SELECT *, CASE WHEN populacao <= a THEN 1 WHEN populacao <= b THEN 2
                WHEN populacao <= c THEN 3 ELSE 4 END AS k
              FROM panel JOIN (
                SELECT ano AS y, quantile_cont(populacao, 0.25) AS a,
                       quantile_cont(populacao, 0.5) AS b, quantile_cont(populacao, 0.75) AS c
                FROM panel GROUP BY 1) ON y = ano)""", "panel"),
    "band_quartile_sketch": sql("""SELECT id_municipio, ano, faixa_populacao, faixa_populacao_ord, faixa_pib,
        faixa_pib_ord, faixa_pib_per_capita, faixa_pib_per_capita_ord FROM
        (SELECT * REPLACE (CAST(id_municipio AS BIGINT) AS id_municipio) FROM serving)""", "serving"),
    "band_duplicate_edges": sql("""SELECT CAST(id_municipio AS BIGINT) AS id_municipio, ano, faixa_pib,
        faixa_pib_ord FROM serving""", "serving"),
    "band_quartile_category": sql(
        "SELECT id_municipio, ano, categoria_pib FROM explored", "explored"),
    # reshape, sets, keys
    "melt_years": sql("""SELECT k.o_custkey AS CO_MUNICIPIO,
        CASE k.o_orderstatus WHEN 'F' THEN 'Pública' WHEN 'O' THEN 'Municipal'
             ELSE 'Estadual' END AS REDE, CAST(y.ano AS INTEGER) AS ano, b.best AS ideb_nota
        FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM score_best) k
        CROSS JOIN (VALUES (1995), (1997), (1999), (2001)) y(ano)
        LEFT JOIN score_best b ON b.o_custkey = k.o_custkey AND b.ano = y.ano
          AND b.o_orderstatus = k.o_orderstatus""", "score_best"),
    "replicate_forward": sql("SELECT * FROM gdp", "gdp"),
    "last_year_rows": sql("""SELECT id_municipio, ano, pib_mil_reais FROM gdp_base
        WHERE ano = (SELECT max(ano) FROM gdp_base)""", "gdp_base"),
    "union_years": """SELECT c_nationkey AS uf, round(c_acctbal, -3) AS valor FROM customer
        UNION ALL SELECT s_nationkey, round(s_acctbal, -3) FROM supplier""",
    "dedup_keep_first": sql("""SELECT id_municipio, nome_rgi, _row FROM territory""", "territory"),
    "unique_keys": sql("""SELECT count(*) AS keys, count(*) FILTER (n > 1) AS duplicate_keys,
        CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS duplicate_rows
        FROM (SELECT c_custkey, count(*) AS n FROM raw_territory GROUP BY 1)""",
        "raw_territory"),
    # joins
    "join_left_two_keys": sql("""SELECT g.id_municipio, g.ano, g.pib_mil_reais, s.ideb_nota
        FROM gdp g LEFT JOIN score s ON g.id_municipio = s.id_municipio AND g.ano = s.ano""",
        "gdp", "score"),
    "join_left_dim": sql("""SELECT g.id_municipio, g.ano, g.sg_uf, t.id_uf, t.nome_uf, t.nome_rgi
        FROM gdp g LEFT JOIN territory t ON g.id_municipio = t.id_municipio""",
        "gdp", "territory"),
    "join_left_null_safe": sql("""SELECT g.id_municipio, g.ano, g.nome_municipio_formatado,
        t.nome_uf, p.nr_projetos, p.nr_instituicoes, p.nr_beneficiados
        FROM gdp g LEFT JOIN territory t ON g.id_municipio = t.id_municipio
        LEFT JOIN projects p ON p.nome_municipio_formatado = g.nome_municipio_formatado
         AND p.nome_uf IS NOT DISTINCT FROM t.nome_uf AND p.ano = g.ano""",
        "gdp", "territory", "projects"),
    "join_left_two_keys_b": sql(f"""SELECT g.id_municipio, g.ano, g.pib_per_capita, d.{RATE},
        d.taxa_distorcao_anos_iniciais, d.taxa_distorcao_anos_finais
        FROM gdp g LEFT JOIN distortion d
          ON g.id_municipio = d.id_municipio AND g.ano = d.ano""", "gdp", "distortion"),
    "map_layer": sql(f"""SELECT s.id_municipio, status_projeto, {HOVER},
        '{{"type":"Point","coordinates":[' || n_nationkey || ',' || n_regionkey || ']}}'
          AS geometry
        FROM serving s JOIN territory t ON CAST(t.id_municipio AS VARCHAR) = s.id_municipio
        JOIN nation ON t.id_uf = n_nationkey WHERE ano = {YEAR}""", "serving", "territory"),
    # cleaning jobs and panel
    "clean_territory": sql("SELECT * EXCLUDE (_row) FROM territory", "territory"),
    "clean_score": sql("SELECT * FROM score", "score"),
    "clean_projects": sql("SELECT * FROM all_projects", "all_projects"),
    "agg_sum_projects": sql("SELECT * EXCLUDE (nome_uf) FROM all_projects", "all_projects"),
    "clean_gdp": sql("SELECT * FROM gdp", "gdp"),
    "clean_distortion": sql("SELECT * FROM all_distortion", "all_distortion"),
    "agg_mean_rates": sql(f"SELECT * EXCLUDE ({NAME}) FROM all_distortion", "all_distortion"),
    "build_panel": sql(f"SELECT {PANEL} FROM panel", "panel"),
    "publish_incremental": sql(f"SELECT {PANEL}, ano = {CHANGED_YEAR} AS written_again FROM panel", "panel"),
    "serving_panel": sql("SELECT * FROM serving", "serving"),
    # dashboard
    "kpi_overview": sql(f"""SELECT * REPLACE ({r('ideb_medio')} AS ideb_medio)
        FROM ({OVERVIEW})""", "serving"),
    "kpi_labels": sql(f"""SELECT CAST(total_municipios AS VARCHAR) AS total_municipios,
        CAST(projetos_ativos AS VARCHAR) AS projetos_ativos,
        replace(format('{{:,}}', estudantes_beneficiados), ',', '.') AS estudantes_beneficiados,
        printf('%.2f', ideb_medio) AS ideb_medio, printf('%.2f', ideb_min) AS ideb_min,
        printf('%.2f', ideb_max) AS ideb_max FROM ({OVERVIEW})""", "serving"),
    "rank_top_score": ranking("ideb_nota", "DESC"),
    "rank_bottom_score": ranking("ideb_nota", "ASC"),
    "rank_top_rate": ranking(RATE, "ASC"),
    "rank_bottom_rate": ranking(RATE, "DESC"),
    "opt_years": sql("SELECT DISTINCT ano FROM serving WHERE ano IS NOT NULL", "serving"),
    "opt_states": sql("SELECT DISTINCT sg_uf FROM serving WHERE sg_uf IS NOT NULL", "serving"),
    "opt_valid_years": sql(
        "SELECT DISTINCT ano FROM serving WHERE ideb_nota IS NOT NULL", "serving"),
    "opt_valid_years_pair": sql(f"""SELECT DISTINCT ano FROM serving
        WHERE pib_per_capita IS NOT NULL AND {RATE} IS NOT NULL""", "serving"),
    "opt_names": sql(f"""SELECT DISTINCT {NAME} FROM serving
        WHERE sg_uf IN ({STATE_LIST})""", "serving"),
    "impact_score": sql(f"""SELECT faixa_pib, faixa_pib_ord, ano, status_projeto,
        {r('avg(ideb_nota)')} AS ideb_nota FROM serving
        WHERE ano IN ({FIRST_YEAR}, {YEAR}) AND sg_uf IS NOT NULL AND ideb_nota IS NOT NULL
        GROUP BY 1, 2, 3, 4""", "serving"),
    "cube_evolution": sql(f"""SELECT ano, count(*) FILTER (status_projeto = 'Com Projetos') AS com_projetos,
        CAST(coalesce(sum(nr_projetos), 0) AS BIGINT) AS projetos_ativos, {r('avg(ideb_nota)')} AS ideb_medio,
        count(DISTINCT id_municipio) AS total_municipios
        FROM serving WHERE sg_uf IS NOT NULL GROUP BY 1""", "serving"),
    "impact_variation": sql(f"""SELECT a.faixa_populacao, a.faixa_populacao_ord,
        a.status_projeto, {r(f'avg(b.{RATE} - a.{RATE})')} AS variacao
        FROM serving a JOIN serving b ON a.id_municipio = b.id_municipio
         AND a.faixa_populacao = b.faixa_populacao AND a.status_projeto = b.status_projeto
        WHERE a.ano = {FIRST_YEAR} AND b.ano = {YEAR} AND a.sg_uf IS NOT NULL
        AND a.{RATE} IS NOT NULL AND b.{RATE} IS NOT NULL GROUP BY 1, 2, 3""", "serving"),
    "impact_variation_by_id": sql(f"""SELECT b.faixa_populacao, b.faixa_populacao_ord,
        b.status_projeto, {r(f'avg(b.{RATE} - a.{RATE})')} AS variacao
        FROM serving a JOIN serving b ON a.id_municipio = b.id_municipio
        WHERE a.ano = {FIRST_YEAR} AND b.ano = {YEAR} AND a.sg_uf IS NOT NULL
        AND a.{RATE} IS NOT NULL AND b.{RATE} IS NOT NULL GROUP BY 1, 2, 3""", "serving"),
    "context_by_segment": sql(f"""SELECT faixa_populacao, faixa_populacao_ord, status_projeto,
        {r('avg(ideb_nota)')} AS valor_medio FROM serving
        WHERE {pairs(YEAR)} GROUP BY 1, 2, 3""", "serving"),
    "context_by_segment_dense": sql(f"""SELECT b.label AS faixa_populacao,
        b.ord AS faixa_populacao_ord, st.label AS status_projeto,
        {r('avg(pib_mil_reais)')} AS valor_medio
        FROM (VALUES ('Pequeno Porte', 1), ('Médio Porte', 2), ('Grande Porte', 3),
                     ('Metrópole', 4)) b(label, ord)
        CROSS JOIN (VALUES ('Com Projetos'), ('Sem Projetos')) st(label)
        LEFT JOIN serving ON faixa_populacao = b.label AND status_projeto = st.label
          AND {pairs(2005)} GROUP BY 1, 2, 3""", "serving"),
    "history_series": sql(f"""SELECT ano, {NAME}, ideb_nota, ano = {YEAR} AS destaque
        FROM serving WHERE ideb_nota IS NOT NULL AND {NAME} IN
        (SELECT {NAME} FROM serving WHERE sg_uf IN ({STATE_LIST}))""", "serving"),
    "scatter_points": sql(f"""SELECT {NAME}, pib_per_capita AS x, {RATE} AS y, populacao,
        status_projeto, tem_projeto FROM serving WHERE {pairs(YEAR)}
        AND pib_per_capita IS NOT NULL AND {RATE} IS NOT NULL""", "serving"),
    "corr_by_year": sql(f"""SELECT ano, status_projeto,
        {r('corr(pib_mil_reais, ideb_nota)', 6)} AS correlacao, count(*) AS pontos FROM serving
        WHERE pib_mil_reais IS NOT NULL AND ideb_nota IS NOT NULL GROUP BY 1, 2""", "serving"),
    "corr_by_year_axes": sql("\nUNION ALL ".join(f"""SELECT ano, status_projeto,
        CASE WHEN var_pop({x}) > 0 AND var_pop(ideb_nota) > 0
          THEN {r(f'covar_pop({x}, ideb_nota) / (stddev_pop({x}) * stddev_pop(ideb_nota))', 6)} END AS correlacao,
        count(*) AS pontos, '{x}' AS eixo FROM serving
        WHERE {x} IS NOT NULL AND ideb_nota IS NOT NULL GROUP BY 1, 2"""
        for x in C.SCATTER_AXES[1:]), "serving"),
    "impact_score_dense": sql(f"""SELECT b.label AS faixa_pib, b.ord AS faixa_pib_ord, y.ano,
        st.label AS status_projeto, {r('avg(ideb_nota)')} AS ideb_nota
        FROM (VALUES ('PIB Baixo', 1), ('PIB Médio-Baixo', 2), ('PIB Médio-Alto', 3),
                     ('PIB Alto', 4)) b(label, ord)
        CROSS JOIN (VALUES ('Com Projetos'), ('Sem Projetos')) st(label)
        CROSS JOIN (VALUES ({FIRST_YEAR}), ({YEAR})) y(ano)
        LEFT JOIN serving s ON faixa_pib = b.label AND status_projeto = st.label AND s.ano = y.ano
          AND sg_uf IS NOT NULL GROUP BY 1, 2, 3, 4""", "serving"),
    "impact_variation_dense": sql(f"""SELECT l.label AS faixa_populacao,
        l.ord AS faixa_populacao_ord, st.label AS status_projeto,
        {r(f'avg(v.change)')} AS variacao
        FROM (VALUES ('Pequeno Porte', 1), ('Médio Porte', 2), ('Grande Porte', 3),
                     ('Metrópole', 4)) l(label, ord)
        CROSS JOIN (VALUES ('Com Projetos'), ('Sem Projetos')) st(label)
        LEFT JOIN (SELECT a.faixa_populacao AS f, a.status_projeto AS s, b.{RATE} - a.{RATE} AS change
          FROM serving a JOIN serving b ON a.id_municipio = b.id_municipio
           AND a.faixa_populacao = b.faixa_populacao AND a.status_projeto = b.status_projeto
          WHERE a.ano = {FIRST_YEAR} AND b.ano = {YEAR} AND a.sg_uf IS NOT NULL) v
        ON v.f = l.label AND v.s = st.label GROUP BY 1, 2, 3""", "serving"),
    "detail_table": sql(f"""SELECT {DETAIL}, tem_projeto FROM serving WHERE {pairs(YEAR)}
        AND regexp_matches({NAME}, '{NAME_QUERY}', 'i')""", "serving"),
    # exploration
    "flag_by_year": crosstab("nullif(count(*) FILTER ({0}), 0)", "ano", "explored", "true"),
    "freq_gdp_category": sql("""SELECT label AS categoria_pib, count(id_municipio) AS linhas
        FROM (VALUES ('Baixo'), ('Médio-Baixo'), ('Médio-Alto'), ('Alto')) c(label)
        LEFT JOIN explored ON categoria_pib = label GROUP BY 1""", "explored"),
    "freq_size": sql("SELECT porte_municipio, count(*) AS linhas FROM explored GROUP BY 1",
        "explored"),
    "score_by_gdp_flag": crosstab(
        f"{r('avg(ideb_nota) FILTER ({0})', 2)}", "categoria_pib", "explored",
        "categoria_pib IS NOT NULL"),
    "score_by_gdp_flag_long": sql(f"""SELECT categoria_pib, f.flag AS tem_projeto_ia,
        {r('avg(ideb_nota) FILTER (e.tem_projeto_ia = f.flag)', 2)} AS ideb_nota
        FROM explored e CROSS JOIN (VALUES ('Não'), ('Sim')) f(flag)
        WHERE categoria_pib IS NOT NULL GROUP BY 1, 2""", "explored"),
    "projects_by_size": sql("""SELECT porte_municipio, coalesce(sum(nr_projetos), 0.0)
        AS nr_projetos FROM explored GROUP BY 1""", "explored"),
    "score_by_size_gdp_flag": crosstab(
        f"{r('avg(ideb_nota) FILTER ({0})', 2)}", "porte_municipio, categoria_pib", "explored",
        "categoria_pib IS NOT NULL"),
}

_WEALTH_AXIS = "(VALUES ('Baixo'), ('Médio-Baixo'), ('Médio-Alto'), ('Alto')) w(wealth)"
_SIZE_AXIS = "(VALUES ('Pequeno'), ('Médio'), ('Grande'), ('Não definido')) z(size)"
_ONE_DIGIT = ", ".join(r(f'"{flag}"', 1) + f' AS "{flag}"' for flag in ("Não", "Sim"))
ORACLE["score_by_gdp_flag_dense"] = f"""SELECT w.wealth AS categoria_pib, {_ONE_DIGIT}
    FROM {_WEALTH_AXIS} LEFT JOIN ({ORACLE["score_by_gdp_flag"]}) t ON t.categoria_pib = w.wealth"""
ORACLE["score_by_size_gdp_flag_dense"] = f"""SELECT z.size AS porte_municipio, w.wealth AS categoria_pib, {_ONE_DIGIT}
    FROM {_SIZE_AXIS} CROSS JOIN {_WEALTH_AXIS} LEFT JOIN ({ORACLE["score_by_size_gdp_flag"]}) t
      ON t.categoria_pib = w.wealth AND t.porte_municipio = z.size"""
# the same answers by another way
ORACLE["build_panel_bucketed"] = ORACLE["build_panel"]
ORACLE["detail_table_indexed"] = ORACLE["detail_table"]
# the cube's answers are those of the panel
ORACLE.update({f"cube_{name}": ORACLE[name] for name in ("kpi_overview", "impact_score", "context_by_segment")})
