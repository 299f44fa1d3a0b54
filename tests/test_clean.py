import pytest

from edupanel import config as C
from edupanel.plans import clean

TERRITORY_SCHEMA = ", ".join(f"`{c}` string" for c in C.TERRITORY_NAMES) + ", _row long"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_territory_keeps_the_first_row_per_id(spark):
    raw = spark.createDataFrame(
        [
            ("26", "Pernambuco", "Recife", "2609600", "Olinda", 3),
            ("26", "Pernambuco", "Recife", "2609600", "Olinda (cópia)", 8),
            ("25", "Paraíba", "Patos", "2510808.0", "Patos", 4),
            (None, "x", "y", None, "sem id", 5),
            (None, "x", "y", None, "sem id 2", 6),
        ],
        TERRITORY_SCHEMA,
    )
    treated = clean.clean_territory(raw)
    assert treated.columns == [
        "id_uf", "nome_uf", "nome_rgi", "id_municipio", "nome_municipio_formatado"
    ]
    assert rows(treated) == rows(
        spark.createDataFrame(
            [
                (26, "Pernambuco", "Recife", 2609600, "OLINDA"),
                (25, "Paraíba", "Patos", 2510808, "PATOS"),
                (None, "x", "y", None, "SEM ID"),
            ],
            treated.schema,
        )
    )


def test_score_keeps_one_network_and_years_without_a_score(spark):
    raw = spark.createDataFrame(
        [
            ("1", "São A", "Pública", "4.5", None),
            ("1", "São A", "Municipal", "9", "9"),
            ("2.0", "B", "Pública", "3", "3.5"),
            (None, "C", "Pública", "1", "1"),
            ("4", "D", "pública", "1", "1"),
            ("5", "E", None, "1", "1"),
        ],
        "CO_MUNICIPIO string, NO_MUNICIPIO string, REDE string, VL_OBSERVADO_2005 string, "
        "VL_OBSERVADO_2007 string",
    )
    treated = clean.clean_score(raw, years=[2005, 2007])
    assert treated.columns == ["id_municipio", "ideb_nota", "ano", "nome_municipio_formatado"]
    assert rows(treated) == [
        (1, 4.5, 2005, "SAO A"), (1, None, 2007, "SAO A"),
        (2, 3.0, 2005, "B"), (2, 3.5, 2007, "B"),
    ]


def test_projects_sum_per_place_and_all_missing_is_zero(spark):
    columns = ", ".join(f"`{c}` string" for c in C.PROJECT_NAMES)
    raw = spark.createDataFrame(
        [
            ("Patos", "PB", "2", "1", "100", "2020"),
            ("PATOS ", "PB", "3", None, "50", "2020"),
            ("Patos", "PB", "1", "1", "1", "2021"),
            ("Natal", "RN", None, None, None, "2020"),
            ("TOTAL", None, "9", "9", "9", "2020"),
            (None, "PB", "9", "9", "9", "2020"),
        ],
        columns + ", ano string",
    )
    treated = clean.clean_projects(raw)
    assert treated.columns == [
        "nome_municipio_formatado", "sg_uf", "ano", "nr_projetos", "nr_instituicoes",
        "nr_beneficiados", "nome_uf",
    ]
    assert rows(treated) == [
        ("NATAL", "RN", 2020, 0.0, 0.0, 0.0, None),
        ("PATOS", "PB", 2020, 5.0, 1.0, 150.0, "Paraíba"),
        ("PATOS", "PB", 2021, 1.0, 1.0, 1.0, "Paraíba"),
    ]


def test_project_counts_that_are_text_fail(spark):
    columns = ", ".join(f"`{c}` string" for c in C.PROJECT_NAMES)
    raw = spark.createDataFrame([("Patos", "PB", "dois", "1", "1", "2020")], columns + ", ano string")
    with pytest.raises(Exception, match="nr_projetos is not a number"):
        clean.clean_projects(raw).collect()


def gdp(spark, data):
    return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in C.GDP_NAMES))


def test_gdp_population_missing_values_and_replication(spark):
    raw = gdp(spark, [
        ("2020", "Nordeste", "1", "Patos", "PB", "50", "10"),
        ("2021", "Nordeste", "1", "Patos", "PB", "60", "12"),
        ("2021", "Nordeste", "2", "Zero", "PB", "60", "0"),
        ("2021", "Nordeste", "3", "Texto", "PB", "1,5", "12"),
        ("2021", "Nordeste", "4", "Falta", "PB", "60", None),
        ("2021", "Nordeste", None, "Sem id", "PB", "60", "12"),
        ("2021", "Nordeste", "5", "Nada", "PB", "0", "0"),
    ])
    treated = clean.clean_gdp(raw)
    assert treated.columns == [
        "ano", "regiao", "id_municipio", "sg_uf", "pib_mil_reais", "pib_per_capita",
        "nome_municipio_formatado", "populacao",
    ]
    found = rows(treated.select("id_municipio", "ano", "populacao"))
    assert found == sorted(
        [(1, 2020, 5000.0)]
        + [(i, y, p) for i, p in ((1, 5000.0), (2, float("inf")), (5, None)) for y in range(2021, 2026)],
        key=repr,
    )
    # newer data does not double a year unless the literal list is asked for
    newer = gdp(spark, [("2023", "N", "1", "Patos", "PB", "60", "12")])
    assert sorted(r.ano for r in clean.clean_gdp(newer).collect()) == [2023, 2024, 2025]
    literal = clean.clean_gdp(newer, target_years=[2022, 2023, 2024, 2025])
    assert sorted(r.ano for r in literal.collect()) == [2022, 2023, 2023, 2024, 2025]


def test_distortion_does_not_depend_on_how_files_are_cut(spark):
    raw = spark.createDataFrame(
        [
            ("2019", "1", "A", "Pública", "10", "1", None, "f1"),
            ("2019", "1", "A", "Pública", "20", None, None, "f1"),
            ("2019", "1", "A", "Pública", "90", "5", "5", "f2"),
            ("2019", "1", "A", "Privada", "99", "99", "99", "f1"),
            ("2020", "2", None, "Pública", "1", "1", "1", "f1"),
            (None, "2", "B", "Pública", "1", "1", "1", "f1"),
        ],
        "NU_ANO_CENSO string, CO_MUNICIPIO string, NO_MUNICIPIO string, NO_DEPENDENCIA string, "
        "FUN_CAT_0 string, FUN_AI_CAT_0 string, FUN_AF_CAT_0 string, _source string",
    )
    treated = clean.clean_distortion(raw)
    assert treated.columns == [
        "id_municipio", "ano", "nome_municipio_formatado", *C.DISTORTION_MEASURES
    ]
    assert rows(treated) == [(1, 2019, "A", 40.0, 3.0, 5.0)]


def test_years_from_float_columns_and_notes_below_the_table(spark):
    names = list(C.GDP_NAMES)
    data = [("2021.0", "N", "1", "A", "PB", "10", "2"), ("Fonte: IBGE", None, None, None, None, None, None)]
    raw = spark.createDataFrame(data, ", ".join(f"`{n}` string" for n in names))
    assert [(r.ano, r.populacao) for r in clean.clean_gdp_base(raw).collect()] == [(2021, 5000.0)]


def test_keep_first_goes_by_file_then_row(spark):
    data = [("1", "x", "r", "5", "later", 1, "b.csv"), ("1", "x", "r", "5", "first", 95, "a.csv")]
    raw = spark.createDataFrame(
        data, ", ".join(f"`{n}` string" for n in C.TERRITORY_NAMES) + ", _row long, _source string")
    assert [r.nome_municipio_formatado for r in clean.clean_territory(raw).collect()] == ["FIRST"]


def test_numeric_measures_lose_nan_only(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (None,)], "x double")
    found = df.select(clean.measure(df, "x").alias("x")).collect()
    assert [r.x for r in found] == [1.5, None, None]
    assert spark.range(2).select(clean.key(spark.range(2), "id")).dtypes[0][1] == "bigint"
