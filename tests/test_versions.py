"""Versioned tables, fingerprints and incremental publishing."""

import csv
import os
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from edupanel import config as C
from edupanel.operators import assert_unique, fingerprint
from edupanel.plans import job
from edupanel.plans import publish as P
from edupanel.sources import VersionConflictError, VersionedTable, write_table
from workload import standin

SF = "/root/testdata/sf0.001"


def bag(df):
    return Counter(map(tuple, df.collect()))


def files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def years(spark, *pairs):
    return spark.createDataFrame(list(pairs), "ano int, v string")


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "t"))


# --- versioned tables ---------------------------------------------------------------------
def test_versions_are_kept_apart(spark, table):
    assert table.manifest() is None and table.versions() == []
    with pytest.raises(FileNotFoundError):
        table.read()
    table.write(years(spark, (1, "a"), (2, "b"), (None, "n")), "ano", info={"by": "first"})
    table.write(years(spark, (2, "B"), (3, "c")), "ano", replace=[2, 3])
    assert bag(table.read()) == Counter([(1, "a"), (2, "B"), (3, "c"), (None, "n")])
    assert bag(table.read(1)) == Counter([(1, "a"), (2, "b"), (None, "n")])
    assert table.read().schema == years(spark).schema and table.manifest(1).info == {"by": "first"}
    assert table.manifest(9) is None


def test_replaced_partitions_only_are_written(spark, table):
    table.write(years(spark, (1, "a"), (2, "b"), (3, "c")), "ano")
    before = files(table.root)
    manifest = table.write(years(spark, (2, "x")), "ano", replace=[2, 3])
    new = files(table.root) - before
    assert {os.path.basename(os.path.dirname(f)) for f in new} == {"ano=2"} and before <= files(table.root)
    assert sorted(manifest.parts) == ["ano=1", "ano=2"]  # nothing was given for 3


def test_null_partition_can_be_replaced(spark, table):
    table.write(years(spark, (1, "a"), (None, "n")), "ano")
    table.write(years(spark, (None, "m")), "ano", replace=[None])
    assert bag(table.read()) == Counter([(1, "a"), (None, "m")])


def test_rows_outside_the_replaced_partitions_are_refused(spark, table):
    table.write(years(spark, (1, "a")), "ano")
    with pytest.raises(ValueError, match="ano=2"):
        table.write(years(spark, (1, "b"), (2, "c")), "ano", replace=[1])
    with pytest.raises(ValueError, match="same columns"):
        table.write(spark.createDataFrame([(1, 2)], "ano int, v int"), "ano", replace=[1])
    with pytest.raises(ValueError, match="partitions"):
        table.write(years(spark, (1, "b")), replace=[1])
    with pytest.raises(ValueError, match="can't be"):
        table.write(years(spark, (1, "b")), "ano", replace=["a/b"])
    assert bag(table.read()) == Counter([(1, "a")]) and table.versions() == [1]


def test_a_write_that_dies_leaves_the_table(spark, table):
    table.write(years(spark, (1, "a")), "ano")
    broken = years(spark, (1, "x"), (2, "y")).repartition(2).withColumn(
        "v", F.when(F.col("ano") == 2, F.raise_error(F.lit("dies"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="dies"):
        table.write(broken, "ano")
    assert bag(table.read()) == Counter([(1, "a")]) and table.versions() == [1]


def test_a_driver_that_dies_before_the_manifest_leaves_the_table(spark, table, monkeypatch):
    table.write(years(spark, (1, "a")), "ano")
    with monkeypatch.context() as patch:
        patch.setattr(VersionedTable, "_publish", lambda self, manifest: (_ for _ in ()).throw(KeyboardInterrupt()))
        with pytest.raises(KeyboardInterrupt):
            table.write(years(spark, (1, "b")), "ano")
    assert bag(table.read()) == Counter([(1, "a")])
    assert len(table.vacuum(keep=1)) == 1  # what the dead write left
    assert bag(table.read()) == Counter([(1, "a")])
    table.write(years(spark, (1, "c")), "ano")
    assert bag(table.read()) == Counter([(1, "c")])


def test_of_two_writers_one_wins(spark, table):
    table.write(years(spark, (1, "a")), "ano")
    held = table.manifest()
    table.write(years(spark, (1, "b")), "ano")
    with pytest.raises(VersionConflictError):
        table._publish(replace(held, version=2))
    assert bag(table.read()) == Counter([(1, "b")])


def test_a_frame_goes_on_reading_its_version(spark, table):
    table.write(years(spark, (1, "a")))
    before = table.read()
    table.write(years(spark, (1, "b")))
    assert bag(before) == Counter([(1, "a")]) and bag(table.read()) == Counter([(1, "b")])


def test_vacuum_keeps_what_versions_name(spark, table):
    table.write(years(spark, (1, "a"), (2, "b")), "ano")
    for n in range(3):
        table.write(years(spark, (2, f"b{n}")), "ano", replace=[2])
    assert len(table.vacuum(keep=2)) == 1  # the first folder still holds year 1
    assert table.versions() == [3, 4]
    assert bag(table.read()) == Counter([(1, "a"), (2, "b2")]) and bag(table.read(3)) == Counter([(1, "a"), (2, "b1")])
    with pytest.raises(ValueError):
        table.vacuum(0)


def test_year_filter_prunes_parts(spark, table):
    table.write(years(spark, (1, "a"), (2, "b")), "ano")
    table.write(years(spark, (2, "c")), "ano", replace=[2])
    df = table.read().where("ano = 2")
    assert "PartitionFilters: [isnotnull(ano" in df._jdf.queryExecution().executedPlan().toString()
    assert bag(df) == Counter([(2, "c")])


def test_empty_tables(spark, table):
    table.write(years(spark), "ano")
    assert table.read().count() == 0 and table.read().columns == ["ano", "v"]
    table.write(years(spark, (1, "a")), "ano", replace=[1])
    table.write(years(spark), "ano", replace=[1])
    assert table.read().count() == 0


def test_plain_replacement_keeps_the_old_table_when_it_fails(spark, tmp_path):
    path = str(tmp_path / "plain")
    write_table(years(spark, (1, "a")), path, "ano")
    with pytest.raises(Exception, match="dies"):
        write_table(years(spark, (1, "b")).withColumn("v", F.raise_error(F.lit("dies"))), path, "ano")
    assert bag(spark.read.parquet(path).select("ano", "v")) == Counter([(1, "a")])
    write_table(years(spark, (2, "b")), path, "ano")
    assert bag(spark.read.parquet(path).select("ano", "v")) == Counter([(2, "b")])
    assert os.listdir(tmp_path) == ["plain"]


# --- fingerprints -------------------------------------------------------------------------
def test_fingerprint_does_not_depend_on_order_or_files(spark):
    rows = spark.range(1000).selectExpr("id % 7 as k", "id as v", "if(id % 3 = 0, null, 'x') as t")
    one = bag(fingerprint(rows, "k"))
    assert one == bag(fingerprint(rows.orderBy(F.desc("v")).repartition(5), "k"))
    assert sum(r[1] for r in one) == 1000


@pytest.mark.parametrize("other", [
    [("a", None), ("b", "c")], [(None, "a"), ("b", "c"), ("b", "c")], [(None, "a"), ("c", "b")], [(None, "a")], [("", "a"), ("b", "c")],
])
def test_fingerprint_tells_rows_apart(spark, other):
    def mark(rows):
        return bag(fingerprint(spark.createDataFrame(rows, "x string, y string")))

    assert mark([(None, "a"), ("b", "c")]) != mark(other)


def test_fingerprint_of_nothing(spark):
    assert fingerprint(years(spark)).first()["rows"] == 0 and fingerprint(years(spark), "ano").count() == 0


# --- uniqueness within the join --------------------------------------------------------------
def test_unique_rows_pass_and_nulls_count_as_different(spark):
    rows = [(1, 1, "a"), (1, 2, "b"), (None, 1, "c"), (None, 1, "d")]
    df = spark.createDataFrame(rows, "k int, y int, v string")
    assert bag(assert_unique(df, ["k", "y"], "t")) == Counter(rows)


def test_repeated_keys_fail_whatever_is_selected(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="t: key more than once: 1"):
        assert_unique(df, ["k"], "t").select(F.lit(1)).collect()


def test_check_rides_on_the_shuffle_of_the_join(spark):
    def joined(check):
        left = spark.range(1000).withColumn("y", F.lit(1))
        right = spark.range(1000).withColumn("y", F.lit(1)).withColumn("v", F.rand())
        right = assert_unique(right, ["id", "y"], "t") if check else right
        plan = left.hint("merge").join(right.hint("merge"), ["id", "y"], "left")
        return plan._jdf.queryExecution().executedPlan().toString()

    assert joined(True).count("Exchange hashpartitioning") == joined(False).count("Exchange hashpartitioning") == 2


# --- publishing ----------------------------------------------------------------------------
def test_published_panel_is_that_of_a_full_build(spark, tmp_path):
    tables, out = standin.treated(spark, SF), str(tmp_path)
    calls = Counter()

    def counted(name, make):
        return lambda: calls.update([name]) or make()

    makers = {name: counted(name, make) for name, make in tables.items()}
    sources = {name: "1" for name in tables}
    first = P.publish(spark, makers, out, sources)
    assert first.cleaned == list(tables) and first.years == list(range(1995, 2006))
    full = bag(standin.build(spark, SF))
    assert bag(P.published_panel(spark, out)) == full
    before = files(f"{out}/{C.TABLE_PANEL}")

    again = P.publish(spark, makers, out, sources)
    assert again == P.Published(1, [], []) and calls == Counter({name: 1 for name in tables})

    changed = {**makers, C.TABLE_PROJECTS: lambda: tables[C.TABLE_PROJECTS]().withColumn(
        "nr_projetos", F.col("nr_projetos") + F.when(F.col("ano") == 1998, 1).otherwise(0))}
    second = P.publish(spark, changed, out, {**sources, C.TABLE_PROJECTS: "2"})
    assert second == P.Published(2, [C.TABLE_PROJECTS], [1998])
    new = files(f"{out}/{C.TABLE_PANEL}") - before
    assert new and {os.path.basename(os.path.dirname(f)) for f in new} == {"ano=1998"}
    assert bag(P.published_panel(spark, out).where("ano != 1998")) == Counter({r: n for r, n in full.items() if r[0] != 1998})
    assert bag(P.published_panel(spark, out, 1)) == full

    # the same rows again from a changed source: cleaned, but no year is joined
    third = P.publish(spark, makers, out, {**sources, C.TABLE_PROJECTS: "3"})
    assert third == P.Published(3, [C.TABLE_PROJECTS], [1998]) and bag(P.published_panel(spark, out)) == full
    assert P.publish(spark, makers, out, {**sources, C.TABLE_PROJECTS: "4"}) == P.Published(3, [C.TABLE_PROJECTS], [])


def test_years_come_and_go_with_the_gdp(spark, tmp_path):
    tables, out = standin.treated(spark, SF), str(tmp_path)
    fewer = {**tables, C.TABLE_GDP: lambda: tables[C.TABLE_GDP]().where("ano != 1996")}
    assert 1996 not in P.publish(spark, fewer, out).years
    assert P.publish(spark, tables, out).years == [1996]
    assert bag(P.published_panel(spark, out)) == bag(standin.build(spark, SF))
    assert P.publish(spark, fewer, out).years == [1996]
    assert P.published_panel(spark, out).where("ano = 1996").count() == 0


def test_a_changed_territory_changes_all_years(spark, tmp_path):
    tables, out = standin.treated(spark, SF), str(tmp_path)
    P.publish(spark, tables, out)
    other = {**tables, C.TABLE_TERRITORY: lambda: tables[C.TABLE_TERRITORY]().withColumn("nome_rgi", F.lit("x"))}
    assert P.publish(spark, other, out).years == list(range(1995, 2006))


def test_a_failing_run_leaves_the_published_panel(spark, tmp_path):
    tables, out = standin.treated(spark, SF), str(tmp_path)
    P.publish(spark, tables, out)
    before = bag(P.published_panel(spark, out))
    twice = {**tables, C.TABLE_SCORE: lambda: tables[C.TABLE_SCORE]().unionByName(tables[C.TABLE_SCORE]())}
    with pytest.raises(Exception, match="key more than once"):
        P.publish(spark, twice, out)
    assert bag(P.published_panel(spark, out)) == before
    assert P.publish(spark, tables, out).years in ([], list(range(1995, 2006)))
    assert bag(P.published_panel(spark, out)) == before


def _raw(base):
    """A small raw folder of CSV sheets."""
    def sheet(path, notes, header, data):
        path.parent.mkdir(parents=True, exist_ok=True)
        with open(path, "w", newline="", encoding="utf-8") as f:
            f.write("".join(f"note {n}\n" for n in range(notes)))
            csv.writer(f).writerows([header, *data])

    places = [(n, f"Lugar {n}", "PB") for n in range(1, 6)]
    sheet(base / "territory" / "t.csv", C.TERRITORY_SKIP, [*C.TERRITORY_NAMES], [[25, "Paraíba", "R", n, name] for n, name, _ in places])
    years_ = [f"{C.SCORE_SOURCE_PREFIX}{y}" for y in C.SCORE_YEARS]
    sheet(base / "score" / "s.csv", C.SCORE_SKIP, [*C.SCORE_NAMES, *years_],
          [[n, name, C.PUBLIC_NETWORK, *[n + i / 10 for i, _ in enumerate(years_)]] for n, name, _ in places])
    for y in C.PROJECT_SHEETS:
        sheet(base / "projects" / f"p {y}.csv", C.PROJECT_SKIP, [*C.PROJECT_NAMES], [[name, uf, 1, 2, 3] for _, name, uf in places[:2]])
    sheet(base / "gdp" / "g.csv", 0, [*C.GDP_NAMES], [[y, "NE", n, name, uf, 1000 * n + y, n] for n, name, uf in places for y in range(2018, 2022)])
    for y in range(2019, 2024):
        sheet(base / "distortion" / f"d_{y}.csv", C.DISTORTION_SKIP, [*C.DISTORTION_NAMES],
              [[y, name, n, C.PUBLIC_NETWORK, n, n, n] for n, name, _ in places])
    return job.RawPaths.under(str(base))


def test_one_changed_yearly_file_rewrites_one_year(spark, tmp_path, capsys):
    raw, out = _raw(tmp_path / "raw"), str(tmp_path / "out")
    assert job.publish(spark, raw, out).years == list(range(2018, 2026))
    assert job.publish(spark, raw, out) == P.Published(1, [], [])
    path = tmp_path / "raw" / "distortion" / "d_2020.csv"
    path.write_text(path.read_text().replace("5,5,5", "5,7,9"))
    done = job.publish(spark, raw, out)
    assert done == P.Published(2, [C.TABLE_DISTORTION], [2020])
    full = job.run(spark, job.scan_raw(spark, raw), str(tmp_path / "full"))
    assert bag(P.published_panel(spark, out)) == bag(full)
    # other settings count as a change of what they concern
    assert job.publish(spark, raw, out, until=2024).cleaned == [C.TABLE_GDP]
    job.main(["--raw", str(tmp_path / "raw"), "--out", out, "--until", "2024", "--publish"])
    assert "wrote the years []" in capsys.readouterr().out
    assert P.published_panel(spark, out).agg(F.max("ano")).first()[0] == 2024
