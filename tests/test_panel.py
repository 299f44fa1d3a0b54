import pytest
from pyspark.sql import functions as F

from edupanel import config as C
from edupanel.operators import DuplicateEdgesError
from edupanel.plans import dashboard as D
from edupanel.plans import exploration as X
from edupanel.plans import panel as P


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


GDP = ("ano int, regiao string, id_municipio long, sg_uf string, pib_mil_reais double, "
       "pib_per_capita double, nome_municipio_formatado string, populacao double")
SCORE = "id_municipio long, ideb_nota double, ano int, nome_municipio_formatado string"
TERRITORY = ("id_uf int, nome_uf string, nome_rgi string, id_municipio long, "
             "nome_municipio_formatado string")
PROJECTS = ("nome_municipio_formatado string, sg_uf string, ano int, nr_projetos double, "
            "nr_instituicoes double, nr_beneficiados double, nome_uf string")
DISTORTION = ("id_municipio long, ano int, nome_municipio_formatado string, "
              "taxa_distorcao_total_fun double, taxa_distorcao_anos_iniciais double, "
              "taxa_distorcao_anos_finais double")


@pytest.fixture(scope="module")
def panel(spark):
    gdp = spark.createDataFrame(
        [
            (2021, "NE", 1, "PB", 10.0, 1.0, "PATOS", 10000.0),
            (2021, "NE", 2, "RN", 20.0, 1.0, "NATAL", 20000.0),
            (2021, "NE", 3, "PB", 30.0, 1.0, "BAYEUX", 30000.0),
            (2020, "NE", 1, "PB", 10.0, 1.0, "PATOS", 10000.0),
        ], GDP)
    score = spark.createDataFrame([(1, 4.5, 2021, "X"), (1, None, 2020, "X")], SCORE)
    territory = spark.createDataFrame(
        [(25, "Paraíba", "Patos", 1, "PATOS"), (25, "Paraíba", "JP", 3, "BAYEUX")], TERRITORY)
    projects = spark.createDataFrame(
        [
            ("PATOS", "PB", 2021, 2.0, 1.0, 10.0, "Paraíba"),
            ("NATAL", "RN", 2021, 1.0, 1.0, 5.0, None),
            ("BAYEUX", "RN", 2021, 7.0, 7.0, 7.0, None),
            ("BAYEUX", "PB", 2021, 0.0, 0.0, 0.0, "Paraíba"),
        ], PROJECTS)
    distortion = spark.createDataFrame(
        [(1, 2021, "PATOS", 10.0, 1.0, 2.0), (1, 2021, "PATOS ANTIGO", 30.0, 3.0, 4.0)],
        DISTORTION)
    return P.join_panel(gdp, score, territory, projects, distortion)


def test_panel_joins(panel):
    assert panel.columns == list(C.PANEL_COLUMNS)
    found = rows(panel.select("id_municipio", "ano", "nome_uf", "nr_projetos", "ideb_nota",
                              "taxa_distorcao_total_fun"))
    assert found == [
        (1, 2020, "Paraíba", None, None, None),
        # two names of one id give two rows
        (1, 2021, "Paraíba", 2.0, 4.5, 10.0),
        (1, 2021, "Paraíba", 2.0, 4.5, 30.0),
        # no territory row, project state outside the mapping: missing matches missing
        (2, 2021, None, 1.0, None, None),
        # the state name is known, so the row without one does not match
        (3, 2021, "Paraíba", 0.0, None, None),
    ]


def test_two_flags_differ_for_a_count_of_zero(panel):
    flags = P.project_flags(panel).select("id_municipio", "ano", "tem_projeto", "status_projeto")
    assert (3, 2021, False, "Sem Projetos") in rows(flags)
    assert (1, 2020, False, "Sem Projetos") in rows(flags)
    assert (2, 2021, True, "Com Projetos") in rows(flags)
    presence = rows(X.presence_flag(panel).select("id_municipio", "ano", X.FLAG))
    assert (3, 2021, "Sim") in presence and (1, 2020, "Não") in presence
    filled = P.project_flags(panel).where("id_municipio = 1 and ano = 2020").first()
    assert (filled.nr_projetos, filled.nr_beneficiados, filled.nr_instituicoes) == (0.0, 0.0, None)


def test_coinciding_edges(panel):
    with pytest.raises(DuplicateEdgesError):  # GDP per capita is 1 everywhere
        P.serving_panel(panel)
    assert X.WEALTH not in X.wealth_bands(panel).columns
    assert X.SIZE in X.exploration_panel(panel).columns


# --- questions over a hand-written serving panel -------------------------------------------
SERVING = ("id_municipio string, ano int, sg_uf string, nome_municipio_formatado string, "
           "populacao double, ideb_nota double, taxa_distorcao_total_fun double, "
           "pib_per_capita double, nr_projetos double, nr_beneficiados double, "
           "tem_projeto boolean, status_projeto string, faixa string, faixa_ord int")


def place(id, year, state, name, score, rate, projects, band):
    has = projects > 0
    status = C.WITH_PROJECTS if has else C.WITHOUT_PROJECTS
    order = {"A": 1, "B": 2, None: None}[band]
    return (id, year, state, name, 1000.0, score, rate, 5.0, projects, projects * 1000, has,
            status, band, order)


@pytest.fixture(scope="module")
def serving(spark):
    return spark.createDataFrame(
        [
            place("1", 2019, "PB", "PATOS", 4.0, 20.0, 1.0, "A"),
            place("1", 2021, "PB", "PATOS", 5.0, 15.0, 1.0, "A"),
            # begins to have projects between the years
            place("2", 2019, "PB", "POMBAL", 3.0, 30.0, 0.0, "A"),
            place("2", 2021, "PB", "POMBAL", 3.5, 20.0, 2.0, "A"),
            # moves to another band
            place("3", 2019, "PE", "OLINDA", 4.0, 10.0, 0.0, "A"),
            place("3", 2021, "PE", "OLINDA", 4.0, 12.0, 0.0, "B"),
            place("4", 2019, "PE", "CARUARU", None, 10.0, 0.0, "B"),
            place("4", 2021, "PE", "CARUARU", 6.0, 13.0, 0.0, "B"),
            # same name in another state
            place("5", 2021, "RN", "PATOS", 2.0, None, 0.0, "B"),
            place("6", 2021, None, "SEM ESTADO", 9.0, 1.0, 0.0, "B"),
            place("7", 2021, "PB", "SEM FAIXA", 5.0, 15.0, 0.0, None),
            place("1", 2020, "PB", "PATOS", None, None, 1.0, "A"),
        ], SERVING)


def test_states_filter(serving):
    assert D.year_and_states(serving, 2021).count() == 6
    assert D.year_and_states(serving, 2021, ["PE"]).count() == 2
    assert D.year_and_states(serving, 2021, []).count() == 0


def test_options(serving):
    assert [r.ano for r in D.year_options(serving).collect()] == [2021, 2020, 2019]
    valid = D.year_options(serving, [D.SCORE], newest_first=False)
    assert [r.ano for r in valid.collect()] == [2019, 2021]
    assert [r.sg_uf for r in D.state_options(serving).collect()] == ["PB", "PE", "RN"]
    names = [r[0] for r in D.name_options(serving, ["PE"]).collect()]
    assert names == ["CARUARU", "OLINDA"]


def test_key_figures_and_labels(serving):
    overview = D.kpi_overview(serving, 2021)
    assert tuple(overview.first()) == (6, 2, 4, 3, 3000, 25.5 / 6, 2.0, 6.0)
    assert tuple(D.kpi_labels(overview).first()) == ("6", "3", "3.000", "4.25", "2.00", "6.00")
    empty = D.kpi_overview(serving, 1999).first()
    assert tuple(empty) == (0, 0, 0, 0, 0, None, None, None)


def test_rankings_break_ties_by_name(serving):
    best = D.ranking(serving, 2021, D.SCORE, size=3)
    assert [r[0] for r in best.collect()] == ["CARUARU", "PATOS", "SEM FAIXA"]
    assert best.columns == [D.NAME, D.SCORE, D.RATE]
    worst = D.ranking(serving, 2021, D.SCORE, best=False, size=2)
    assert [tuple(r)[:2] for r in worst.collect()] == [("PATOS", 2.0), ("POMBAL", 3.5)]
    low = D.ranking(serving, 2021, D.RATE, size=1, states=["PB", "PE"])
    assert [tuple(r) for r in low.collect()] == [("OLINDA", 12.0, 4.0)]
    high = D.ranking(serving, 2021, D.RATE, best=False, size=1)
    assert high.first()[0] == "POMBAL"


def test_map_layer_draws_only_places_with_an_outline(spark, serving):
    outlines = spark.createDataFrame([("1", "{}"), ("99", "{}")], "id string, geometry string")
    layer = D.map_layer(serving, outlines, 2021)
    assert [r.id_municipio for r in layer.collect()] == ["1"]
    assert layer.columns == ["id_municipio", "status_projeto", *C.HOVER_COLUMNS, "geometry"]


def test_impact_score(serving):
    found = rows(D.impact_score(serving, "faixa", 2019, 2021))
    assert found == [
        ("A", 1, 2019, "Com Projetos", 4.0), ("A", 1, 2019, "Sem Projetos", 3.5),
        ("A", 1, 2021, "Com Projetos", 4.25), ("B", 2, 2021, "Sem Projetos", 4.0),
    ]
    with pytest.raises(ValueError):
        D.impact_score(serving, "faixa", 2021, 2021)


def test_variation_counts_only_places_that_keep_status_and_band(serving):
    found = rows(D.impact_variation(serving, "faixa", 2019, 2021))
    assert found == [("A", 1, "Com Projetos", -5.0), ("B", 2, "Sem Projetos", 3.0)]
    by_id = rows(D.impact_variation(serving, "faixa", 2019, 2021, by_id_only=True))
    assert by_id == [("A", 1, "Com Projetos", -7.5), ("B", 2, "Sem Projetos", 2.5)]


def test_context_observed_and_dense(serving):
    context = D.context_by_segment(serving, 2020, D.SCORE, "faixa")
    assert rows(context) == [("A", 1, "Com Projetos", None)]
    context = D.context_by_segment(serving, 2021, D.SCORE, "faixa")
    dense = D.context_dense(context, "faixa", ["A", "B"])
    assert rows(dense.select("faixa", "faixa_ord", "status_projeto", "valor_medio")) == [
        ("A", 1, "Com Projetos", 4.25), ("A", 1, "Sem Projetos", None),
        ("B", 2, "Com Projetos", None), ("B", 2, "Sem Projetos", 4.0),
    ]


def test_history_follows_names_across_states(spark, serving):
    found = rows(D.history_series(serving, ["PATOS"], D.SCORE, 2021))
    assert found == [
        (2019, "PATOS", 4.0, False), (2021, "PATOS", 2.0, True), (2021, "PATOS", 5.0, True)
    ]
    chosen = spark.createDataFrame([("PATOS",)], f"{D.NAME} string")
    assert rows(D.history_series(serving, chosen, D.SCORE, 2021)) == found
    by_id = D.history_series(serving, ["1"], D.SCORE, by="id_municipio")
    assert rows(by_id) == [(2019, "PATOS", 4.0, False), (2021, "PATOS", 5.0, False)]


def test_scatter_and_correlation(serving):
    points = D.scatter_points(serving, D.SCORE, D.RATE, 2021)
    assert points.count() == 5
    ordered = [r.tem_projeto for r in D.draw_order(points).collect()]
    assert ordered == sorted(ordered)
    found = {(r.ano, r.status_projeto): r.pontos
             for r in D.correlation_by_year(serving, D.SCORE, D.RATE).collect()}
    assert found[2021, "Com Projetos"] == 2


def test_detail_table(serving):
    table = D.detail_table(serving, 2021, search="^p")
    assert table.columns == [*C.DETAIL_COLUMNS, "tem_projeto"]
    assert sorted(r[0] for r in table.collect()) == ["PATOS", "PATOS", "POMBAL"]
    assert D.detail_table(serving, 2021).count() == 6


def test_projects_by_size_sums_missing_to_zero(panel):
    sized = X.size_bands(panel)
    assert rows(X.projects_by_size(sized.where("ano = 2020"))) == [("Pequeno", 0.0)]
    assert rows(X.size_frequencies(sized)) == [("Médio", 1), ("Pequeno", 4)]


def test_wealth_frequencies_show_empty_bands(spark):
    df = spark.createDataFrame([("Alto",), ("Alto",), (None,)], f"{X.WEALTH} string")
    assert rows(X.wealth_frequencies(df)) == [
        ("Alto", 2), ("Baixo", 0), ("Médio-Alto", 0), ("Médio-Baixo", 0)
    ]


def test_score_crosstab_and_its_long_form(spark):
    df = spark.createDataFrame(
        [("Alto", "Sim", 5.0), ("Alto", "Sim", 5.01), ("Alto", "Não", None), ("Baixo", "Não", 3.0),
         (None, "Sim", 1.0)],
        f"{X.WEALTH} string, {X.FLAG} string, ideb_nota double",
    )
    crosstab = X.score_by_wealth(df)
    assert crosstab.columns == [X.WEALTH, "Não", "Sim"]
    assert rows(crosstab) == [("Alto", None, 5.0), ("Baixo", 3.0, None)]
    assert rows(X.score_by_wealth_long(crosstab)) == [
        ("Alto", "Não", None), ("Alto", "Sim", 5.0), ("Baixo", "Não", 3.0), ("Baixo", "Sim", None)
    ]
    sized = df.withColumn(X.SIZE, F.lit("Grande"))
    assert rows(X.score_by_size_and_wealth(sized))[0] == ("Grande", "Alto", None, 5.0)
