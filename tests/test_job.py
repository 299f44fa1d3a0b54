"""Raw files of every table -> six outputs -> questions over the written panel."""

import csv
from dataclasses import replace

import pytest

from edupanel import config as C
from edupanel.plans import dashboard as D
from edupanel.plans import exploration as X
from edupanel.plans import job
from edupanel.plans import panel as P
from edupanel.sources import MissingSourceError
from workload import workbooks

OUTPUTS = [
    C.TABLE_TERRITORY, C.TABLE_SCORE, C.TABLE_PROJECTS, C.TABLE_GDP, C.TABLE_DISTORTION,
    C.TABLE_PANEL,
]


def write_csv(path, notes, header, data):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write("".join(f"note {n}\n" for n in range(notes)))
        writer = csv.writer(f)
        writer.writerow(header)
        writer.writerows(data)


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    base = tmp_path_factory.mktemp("raw")
    places = [(n, f"Município {n}", "PB" if n % 2 else "RN") for n in range(1, 13)]
    names = {"PB": "Paraíba", "RN": "Rio Grande do Norte"}
    write_csv(
        base / "territory" / "dtb.csv", C.TERRITORY_SKIP, ["extra", *C.TERRITORY_NAMES],
        [["", 25, names[uf], "Região", n, name] for n, name, uf in places if n != 12],
    )
    years = [f"{C.SCORE_SOURCE_PREFIX}{y}" for y in C.SCORE_YEARS]
    write_csv(
        base / "score" / "ideb.csv", C.SCORE_SKIP, [*C.SCORE_NAMES, *years],
        [[n, name, network, *["-" if y < 2009 else round(3 + n / 10, 1) for y in C.SCORE_YEARS]]
         for n, name, _ in places for network in (C.PUBLIC_NETWORK, "Municipal")],
    )
    (base / "projects").mkdir()
    sheet = [list(C.PROJECT_NAMES)] + [[name, uf, 1, 2, 30 * n] for n, name, uf in places[:4]]
    sheet += [["TOTAL", None, 4, 8, 300]]
    workbooks.write(base / "projects" / "projetos.xlsx", {y: sheet for y in C.PROJECT_SHEETS})
    write_csv(
        base / "gdp" / "pib.csv", 0, C.GDP_NAMES,
        [[y, "Nordeste", n, name, uf, n * 1000 + y, "--" if n == 11 else n]
         for n, name, uf in places for y in range(2010, 2022)],
    )
    for y in range(2019, 2024):
        write_csv(
            base / "distortion" / f"tdi_{y}.csv", C.DISTORTION_SKIP, C.DISTORTION_NAMES,
            [[y, name, n, network, n, "--", 2 * n] for n, name, _ in places
             for network in (C.PUBLIC_NETWORK, "Privada")],
        )
    return base


@pytest.fixture(scope="module")
def built(spark, raw, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    return out, job.run(spark, job.scan_raw(spark, job.RawPaths.under(str(raw))), out)


def test_six_outputs(spark, built):
    out, panel = built
    for name in OUTPUTS:
        assert spark.read.parquet(f"{out}/{name}").count() > 0
    assert panel.columns == list(C.PANEL_COLUMNS)
    assert panel.count() == 11 * 16  # 2010-2021 and four replicated years


def test_panel_values(built):
    _, panel = built
    row = panel.where("id_municipio = 1 and ano = 2021").first()
    assert row.nome_municipio_formatado == "MUNICIPIO 1" and row.nome_uf == "Paraíba"
    assert (row.pib_mil_reais, row.populacao) == (3021.0, 3021000.0)
    assert (row.ideb_nota, row.nr_projetos, row.nr_beneficiados) == (3.1, 1.0, 30.0)
    assert (row.taxa_distorcao_total_fun, row.taxa_distorcao_anos_iniciais) == (1.0, None)
    # the state name of RN is known to the territory but not to the project table
    assert panel.where("id_municipio = 2 and nr_projetos is not null").count() == 0
    # id 12 is not in the territory; its projects are not either
    assert panel.where("id_municipio = 12").first().nome_uf is None
    replicated = panel.where("id_municipio = 1 and ano = 2023").first()
    assert (replicated.pib_mil_reais, replicated.ideb_nota) == (3021.0, 3.1)


def test_rerun_gives_the_same_panel(spark, raw, built):
    out, panel = built
    before = sorted(map(tuple, panel.collect()), key=repr)
    again = job.run(spark, job.scan_raw(spark, job.RawPaths.under(str(raw))), out)
    assert sorted(map(tuple, again.collect()), key=repr) == before


def test_questions_over_the_written_panel(spark, built):
    out, _ = built
    panel = job.load_panel(spark, out, cached=True)
    serving = P.serving_panel(panel)
    assert D.kpi_overview(serving, 2023).first().com_projetos == 2
    assert D.ranking(serving, 2023, D.SCORE).count() == 5
    assert D.impact_variation(serving, "faixa_pib_per_capita", 2019, 2023).count() > 0
    assert X.score_by_wealth(X.exploration_panel(panel)).count() == 4
    panel.unpersist()


def test_missing_raw_file_names_the_table(spark, raw):
    paths = replace(job.RawPaths.under(str(raw)), score=str(raw / "none"))
    with pytest.raises(MissingSourceError, match="score"):
        job.scan_raw(spark, paths)


def test_projects_from_csv_exports(spark, raw, built, tmp_path):
    header, data = list(C.PROJECT_NAMES), [[f"Município {n}", "PB" if n % 2 else "RN", 1, 2, 30 * n] for n in range(1, 5)]
    for year in C.PROJECT_SHEETS:
        write_csv(tmp_path / "projects" / f"projetos {year}.csv", C.PROJECT_SKIP, header, data)
    paths = replace(job.RawPaths.under(str(raw)), projects=str(tmp_path / "projects"))
    panel = job.run(spark, job.scan_raw(spark, paths), str(tmp_path / "out"))
    before = job.load_panel(spark, built[0])
    assert sorted(map(tuple, panel.collect()), key=repr) == sorted(map(tuple, before.collect()), key=repr)


def test_a_place_twice_in_a_year_fails(spark, raw, tmp_path):
    tables = job.scan_raw(spark, job.RawPaths.under(str(raw)))
    tables["score"] = tables["score"].union(tables["score"])
    with pytest.raises(job.DuplicateKeysError, match="more than once"):
        job.run(spark, tables, str(tmp_path / "out"))


def test_job_parameters(raw, tmp_path, spark):
    job.main(["--raw", str(raw), "--out", str(tmp_path / "out"), "--until", "2022",
              "--project-sheets", "2020", "2021", "--states", '{"PB": "Paraíba"}'])
    panel = job.load_panel(spark, str(tmp_path / "out"))
    assert panel.count() == 11 * 13
    assert panel.where("nr_projetos is not null").select("ano").distinct().count() == 2


def test_command_line(raw, tmp_path, spark):
    job.main(["--raw", str(raw), "--out", str(tmp_path / "out")])
    assert job.load_panel(spark, str(tmp_path / "out")).count() == 176
