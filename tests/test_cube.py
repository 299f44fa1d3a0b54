"""The stored cube against the questions over the panel's rows."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from edupanel import config as C
from edupanel.plans import cube as K
from edupanel.plans import dashboard as D
from workload import standin

SF = "/root/testdata/sf0.001"
STATE_CHOICES = [None, [], ["NATION_1", "NATION_3"], ["NATION_8"], ["nowhere"]]


@pytest.fixture(scope="module")
def serving(spark):
    return standin.stored_serving(spark, SF)


@pytest.fixture(scope="module")
def cube(spark):
    return standin.stored_cube(spark, SF)


def shown(df):
    names = sorted(df.columns)
    return Counter(
        tuple(round(r[n], 6) if isinstance(r[n], float) else r[n] for n in names) for r in df.collect())


@pytest.mark.parametrize("states", STATE_CHOICES)
@pytest.mark.parametrize("year", [1996, 2001, 2005, 1900])
def test_overview(serving, cube, year, states):
    assert shown(K.kpi_overview(cube, year, states)) == shown(D.kpi_overview(serving, year, states))
    assert K.kpi_overview(cube, year).columns == D.kpi_overview(serving, year).columns


@pytest.mark.parametrize("segment", K.SEGMENTS)
@pytest.mark.parametrize("indicator", [D.SCORE, D.RATE, "pib_per_capita"])
def test_segments(serving, cube, segment, indicator):
    for states in (None, ["NATION_1", "NATION_3", "NATION_8"]):
        assert shown(K.impact_score(cube, segment, 1997, 2001, states, indicator)) == shown(
            D.impact_score(serving, segment, 1997, 2001, states, indicator))
        for year in (1998, 2001):
            assert shown(K.context_by_segment(cube, year, indicator, segment, states)) == shown(
                D.context_by_segment(serving, year, indicator, segment, states))


@pytest.mark.parametrize("not_null", [[], [D.SCORE], ["pib_per_capita", D.RATE]])
def test_years(serving, cube, not_null):
    # the cube knows that a year has values of each, not that one row has both
    rows = [r.ano for r in D.year_options(serving, not_null[:1]).collect()]
    if len(not_null) > 1:
        rows = [y for y in rows if serving.where(f"ano = {y} and {not_null[1]} is not null").count()]
    assert [r.ano for r in K.year_options(cube, not_null).collect()] == rows


def test_distinct_places_of_any_union(serving, cube):
    for keys in ([], ["sg_uf"], ["status_projeto"], ["ano", "sg_uf"]):
        wanted = serving.groupBy(*keys).agg(F.countDistinct("id_municipio").alias("places"))
        assert shown(K.distinct_places(cube.places, *keys)) == shown(wanted)


def test_answers_read_no_panel_row(spark, cube):
    for df in (K.kpi_overview(cube, 2001), K.impact_score(cube, "faixa_pib", 1997, 2001), K.evolution(cube),
               K.context_by_segment(cube, 2001, D.SCORE, "faixa_populacao")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        paths = re.findall(r"Location: \w+\(\d+ paths?\)\[([^\]]*)\]", plan)
        assert paths and all("/cube-" in p for p in paths)
        assert not re.search("Python|CartesianProduct|BroadcastNestedLoopJoin", plan)
    assert "PartitionFilters: [isnotnull(ano" in plan


def test_cells_are_merged_before_the_shuffle(serving):
    plan = K.build_cube(serving).cells._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"HashAggregate.*\n.*Exchange.*\n.*HashAggregate", plan)


COLUMNS = "ano int, sg_uf string, id_municipio string, status_projeto string, nr_projetos double, nr_beneficiados double, " \
    + ", ".join(f"{s} string, {s}_ord int" for s in K.SEGMENTS) + ", " + ", ".join(f"{i} double" for i in K.INDICATORS)


def panel_row(ano, uf, place, score, band="b"):
    status = C.WITH_PROJECTS if place and int(place) % 2 else C.WITHOUT_PROJECTS
    return (ano, uf, place, status, 1.0, None, *[x for _ in K.SEGMENTS for x in (band, None if band is None else 1)],
            score, *[None] * (len(K.INDICATORS) - 1))


def test_nulls_and_far_ids(spark, tmp_path):
    rows = [
        panel_row(1, "A", "5", 2.0), panel_row(1, "A", "5", 4.0), panel_row(1, "B", "5", None), panel_row(1, None, "7", 9.0),
        panel_row(1, "A", str(2**40), 1.0, None), panel_row(1, "A", None, 3.0), panel_row(2, "A", "-3", None),
    ]
    frame = spark.createDataFrame(rows, COLUMNS)
    cube = K.store_cube(frame, str(tmp_path / "k"))
    for year in (1, 2):
        assert shown(K.kpi_overview(cube, year)) == shown(D.kpi_overview(frame, year))
        assert shown(K.context_by_segment(cube, year, D.SCORE, "faixa_pib")) == shown(
            D.context_by_segment(frame, year, D.SCORE, "faixa_pib"))
    assert shown(K.impact_score(cube, "faixa_pib", 1, 2)) == shown(D.impact_score(frame, "faixa_pib", 1, 2))
    assert [tuple(r) for r in K.evolution(cube).orderBy("ano").select("ano", "total_municipios", "ideb_medio").collect()] == [
        (1, 2, 2.5), (2, 1, None)]
    again = K.store_cube(frame.where("ano = 1"), str(tmp_path / "k"))
    assert [r.ano for r in K.year_options(again).collect()] == [1]
    assert [r.ano for r in K.year_options(cube).collect()] == [2, 1]  # still its own version


def test_empty_panel(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert shown(K.kpi_overview(K.build_cube(empty), 1)) == shown(D.kpi_overview(empty, 1))
    assert K.evolution(K.build_cube(empty)).count() == 0


def test_unknown_questions(cube):
    for call in (lambda: K.context_by_segment(cube, 1, "nr_projetos", "faixa_pib"), lambda: K.impact_score(cube, "sg_uf", 1, 2),
                 lambda: K.impact_score(cube, "faixa_pib", 2, 1)):
        with pytest.raises(ValueError):
            call()
