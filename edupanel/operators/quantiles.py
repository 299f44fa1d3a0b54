"""Exact quantiles by distributed selection, and quantile bands.

``percentile`` keeps every distinct value in one buffer and ``percentile_approx`` does not
interpolate, so neither gives exact quartiles of a large column. Selection does: count the
values in monotone cells, keep the few cells that hold the wanted ranks, split those again,
and read the values once a cell is small. Each round is one aggregation that is combined
before the shuffle and returns a bounded number of cells, whatever the data size; a value
that fills a third of the column is one cell entry. Later rounds read only the value
ranges still open, which are literals and reach the Parquet scan.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from edupanel.session import drop_staged, stage

QUARTILES = (0.0, 0.25, 0.5, 0.75, 1.0)

# number of a cell, never decreasing with v: quarter octaves on either side of 0
OCTAVE_CELL = """CAST(signum(v) * CASE WHEN v = 0 THEN 0 WHEN abs(v) = double('inf') THEN 1000000
    ELSE floor(log2(abs(v)) * 4) + 4400 END AS INT)"""
SPLITS = 4096
# rows whose values may be returned to the driver; beyond it the cells are split again. Only the
# number of rounds depends on it
DIRECT_ROWS = 8_192
# numbers kept in a rank sketch; its rank error is about 2.3 / size ** 0.9, and a little more is taken on either side
SKETCH_SIZE = 8_192
SKETCH_MARGIN = 4.0


class ChangedInputError(RuntimeError):
    """The rows differ between two passes over them, so no rank can be told; store the table first."""


class DuplicateEdgesError(ValueError):
    """The quantile edges are not all different, so the labels cannot be assigned."""


@dataclass(frozen=True)
class _Cell:
    low: float
    high: float
    below: int
    rows: int

    def holds(self, rank: int) -> bool:
        return self.below <= rank < self.below + self.rows

    def value(self, rank: int) -> float | None:
        """The value at ``rank`` where the ends of the cell give it away."""
        if rank == self.below or self.low == self.high:
            return self.low
        return self.high if rank == self.below + self.rows - 1 else None


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float] = QUARTILES
) -> dict[str, list[float] | None]:
    """Linearly interpolated quantiles of each column, nulls and NaN left out.

    An action, like ``DataFrame.approxQuantile``; all columns share each pass. ``df`` is read
    in each round, so it should be a stored table rather than a long computation. A column
    without values yields None.
    """
    values = [f"CAST({_name(c)} AS DOUBLE)" for c in columns]
    known, sizes = _selected(df, values, lambda i, rows: _ranks(rows, probabilities))
    return {
        name: [_interpolate(known, i, sizes[i], p) for p in probabilities] if sizes[i] else None
        for i, name in enumerate(columns)
    }


def _selected(
    df: DataFrame, values: Sequence[str], ranks_of: Callable[[int, int], set[int]]
) -> tuple[dict[tuple[int, int], float], dict[int, int]]:
    """The values at the wanted ranks of each column, which depend on its number of rows, and these numbers."""
    counted = {i: [] for i in range(len(values))}
    by_octave = _stacked(df, values).groupBy("c", F.expr(OCTAVE_CELL).alias("part"))
    for i, _, *cell in by_octave.agg(F.min("v"), F.max("v"), F.count("v")).collect():
        counted[i].append(cell)
    cells = {i: _accumulate(found, 0) for i, found in counted.items()}
    sizes = {i: sum(c.rows for c in found) for i, found in cells.items()}
    ranks = {i: ranks_of(i, sizes[i]) for i in cells}
    known: dict[tuple[int, int], float] = {}

    while True:
        open_cells: dict[int, list[_Cell]] = {}
        for i, found in cells.items():
            for cell in found:
                held = {rank: cell.value(rank) for rank in ranks[i] if cell.holds(rank)}
                known.update({(i, rank): v for rank, v in held.items() if v is not None})
                if None in held.values():
                    open_cells.setdefault(i, []).append(cell)
        pending = sum(c.rows for found in open_cells.values() for c in found)
        if not pending:
            break
        cells = _refine(df, values, open_cells, direct=pending <= DIRECT_ROWS)
    return known, sizes


def bracketed_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float] = QUARTILES, size: int = SKETCH_SIZE
) -> dict[str, list[float] | None]:
    """The quantiles of ``exact_quantiles`` from two passes over ``df``, however many rows there are.

    The first pass merges a rank sketch per column, whose quantiles a little below and above a wanted rank
    bracket the value there. The second pass counts the values below each bracket and at its ends, and stages those
    strictly between, a small share of the rows; the ranks that lie there are then sought in what was staged. A value that
    fills a third of the column ends its brackets, so it is counted and not staged. A sketch misses a rank with
    a probability of less than one in a hundred; the counts tell, and ``exact_quantiles`` takes over.
    """
    values = [f"CAST({_name(c)} AS DOUBLE)" for c in columns]
    margin = SKETCH_MARGIN / size ** 0.9
    # the ends of a column are exact in a sketch
    around = [p + sign * margin * (0 < p < 1) for p in probabilities for sign in (-1, 1)]
    asked = f"array({', '.join(_number(min(1.0, max(0.0, x))) for x in around)})"
    kept = df.select(*[F.expr(f"CASE WHEN NOT isnan({v}) THEN {v} END").alias(f"v{i}") for i, v in enumerate(values)])
    kept = kept.agg(*[
        part for i in range(len(columns))
        for part in (F.count(f"v{i}").alias(f"n{i}"), F.kll_sketch_agg_double(f"v{i}", F.lit(size)).alias(f"k{i}"))])
    first = kept.select(*[
        part for i in range(len(columns))
        for part in (f"n{i}", F.expr(f"CASE WHEN n{i} > 0 THEN kll_sketch_get_quantile_double(k{i}, {asked}) END").alias(f"q{i}"))
    ]).first()
    sizes = [first[f"n{i}"] for i in range(len(columns))]
    brackets = [
        (i, p, *first[f"q{i}"][2 * k:2 * k + 2]) for i, n in enumerate(sizes) if n for k, p in enumerate(probabilities)]
    if not brackets:
        return {name: None for name in columns}

    watch, inside = _bracket_counts(df, values, brackets)
    counts = watch.get
    if any(counts[f"n{i}"] != n for i, n in enumerate(sizes)):
        raise ChangedInputError("a column has another number of values in the second pass than in the first")
    known: dict[tuple[int, int], float] = {}
    between: dict[int, dict[int, int]] = {}
    for b, (i, p, low, high) in enumerate(brackets):
        for rank in _ranks(sizes[i], [p]):
            place = rank - counts[f"below{b}"]
            if place < 0 or place >= counts[f"low{b}"] + counts[f"in{b}"] + counts[f"high{b}"]:
                return exact_quantiles(df, columns, probabilities)
            if place < counts[f"low{b}"]:
                known[i, rank] = low
            elif place < counts[f"low{b}"] + counts[f"in{b}"]:
                between.setdefault(b, {})[place - counts[f"low{b}"]] = rank
            else:
                known[i, rank] = high
    if between:
        columns_of = list(between)
        found, _ = _selected(
            inside, [f"CASE WHEN b = {b} THEN v END" for b in columns_of], lambda k, rows: set(between[columns_of[k]]))
        known.update({(brackets[columns_of[k]][0], between[columns_of[k]][place]): v for (k, place), v in found.items()
                      if place in between[columns_of[k]]})
    drop_staged(inside)
    return {
        name: [_interpolate(known, i, sizes[i], p) for p in probabilities] if sizes[i] else None
        for i, name in enumerate(columns)
    }


def _bracket_counts(df: DataFrame, values: Sequence[str], brackets) -> tuple[Observation, DataFrame]:
    """Counts around every bracket, and the values strictly between its ends, staged as (b, v), from one pass.

    The counts are observed in the tasks that write, whose results Spark takes once each.
    """
    watched, numbers = [F.count_if(F.col("c") == i).alias(f"n{i}") for i in range(len(values))], []
    for b, (i, _, low, high) in enumerate(brackets):
        ends = {
            "below": f"v < {_number(low)}", "low": f"v = {_number(low)}",
            "in": f"v > {_number(low)} AND v < {_number(high)}",
            "high": f"v = {_number(high)} AND v > {_number(low)}",
        }
        watched += [F.count_if(F.expr(f"c = {i} AND {test}")).alias(f"{name}{b}") for name, test in ends.items()]
        numbers.append(f"CASE WHEN c = {i} AND {ends['in']} THEN {b} END")
    watch = Observation()
    rows = _stacked(df, values).observe(watch, *watched)
    inside = rows.selectExpr(f"explode(array_compact(array({', '.join(numbers)}))) AS b", "v")
    return watch, stage(inside, "brackets")


def approximate_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float] = QUARTILES,
    accuracy: int = 10_000,
) -> dict[str, list[float] | None]:
    """One-pass sketch: values with a rank error of up to rows/accuracy, not interpolated."""
    values = [F.when(~F.isnan(_name(c)), F.col(_name(c)).cast("double")) for c in columns]
    wanted = [F.percentile_approx(v, list(probabilities), accuracy) for v in values]
    return dict(zip(columns, df.agg(*wanted).first()))


def quantile_bands(
    df: DataFrame,
    bands: Sequence[tuple[str, str, Sequence[str]]],
    on_duplicate_edges: str = "raise",
    method: str = "exact",
    partition_by: str | None = None,
) -> DataFrame:
    """Add ``<out>`` (label) and ``<out>_ord`` (1..n) for each (column, out, labels).

    Bands are equal-frequency, open below and closed above, the lowest edge included; null
    stays null. Finding the edges is an action, the bands themselves are a plain CASE. Edges
    that coincide leave fewer bands than labels: that is an error, or with ``skip`` the
    band columns are left out. ``exact`` and ``sketch`` find the same edges, the second in two passes over any input;
    ``approx`` takes values near them. Edges are those of all rows together, or with
    ``partition_by`` of each value's rows; the edges are then a table joined on that value,
    rows without a value get no band, and the rounds do not depend on how many values there are.
    """
    if on_duplicate_edges not in ("raise", "skip"):
        raise ValueError("on_duplicate_edges must be 'raise' or 'skip'")
    if partition_by is not None:
        return _keyed_bands(df, bands, on_duplicate_edges, method, partition_by)
    edges = _edges(df, bands, method)
    added: dict[str, Column] = {}
    for column, out, labels in bands:
        cut = edges[column, len(labels)]
        broken = cut is None or len(set(cut)) < len(cut)
        if broken and on_duplicate_edges == "skip":
            continue
        if broken:
            raise DuplicateEdgesError(f"{column}: edges {cut} do not form {len(labels)} bands")
        limits = [_number(edge) for edge in cut[1:]]
        added[out] = _band(column, limits, [_text(label) for label in labels])
        added[f"{out}_ord"] = _band(column, limits, [str(k + 1) for k in range(len(labels))])
    return df.withColumns(added) if added else df


def _keyed_bands(df: DataFrame, bands, on_duplicate_edges: str, method: str, part: str) -> DataFrame:
    find = {"exact": _keyed_quantiles, "sketch": _keyed_quantiles, "approx": _keyed_approximate}[method]
    edges = stage(find(df, part, bands), "edges")
    values = df.select(F.col(_name(part)).alias("_p")).na.drop().distinct()
    broken = [
        F.count_if(F.expr(f"_e{i} IS NULL OR size(array_distinct(_e{i})) < size(_e{i})")).alias(f"b{i}")
        for i in range(len(bands))
    ]
    counts = values.join(edges, "_p", "left").agg(F.count("*").alias("parts"), *broken).first()
    added: dict[str, Column] = {}
    for i, (column, out, labels) in enumerate(bands):
        if counts[f"b{i}"] and on_duplicate_edges == "skip":
            continue
        if counts[f"b{i}"]:
            raise DuplicateEdgesError(
                f"{column}: edges of {counts[f'b{i}']} values of {part} do not form {len(labels)} bands")
        limits = [f"_e{i}[{k + 1}]" for k in range(len(labels))]
        added[out] = _band(column, limits, [_text(label) for label in labels])
        added[f"{out}_ord"] = _band(column, limits, [str(k + 1) for k in range(len(labels))])
    if not added:
        return df
    joined = df.join(edges, df[_name(part)] == edges["_p"], "left")
    return joined.withColumns(added).select(*[_name(c) for c in df.columns], *added)


def _keyed_approximate(df: DataFrame, part: str, bands) -> DataFrame:
    wanted = [
        F.percentile_approx(
            F.when(~F.isnan(_name(column)), F.col(_name(column)).cast("double")),
            [k / len(labels) for k in range(len(labels) + 1)], 10_000,
        ).alias(f"_e{i}")
        for i, (column, _, labels) in enumerate(bands)
    ]
    return df.where(F.col(_name(part)).isNotNull()).groupBy(F.col(_name(part)).alias("_p")).agg(*wanted)


def _keyed_quantiles(df: DataFrame, part: str, bands) -> DataFrame:
    """(_p, _e0, _e1, ...): the edges of each value of ``part``, an array per band column.

    The rounds of ``exact_quantiles`` for all values at once, on tables: cells are counted per value
    and column, those that hold a wanted rank are joined back to the rows and split.
    """
    values = [f"CAST({_name(column)} AS DOUBLE)" for column, _, _ in bands]
    named = df.where(F.col(_name(part)).isNotNull()).select(F.col(_name(part)).alias("_p"), "*")
    items = ", ".join(f"struct({i} AS c, {v} AS v)" for i, v in enumerate(values))
    rows = named.selectExpr("_p", f"inline(array({items}))").where("v IS NOT NULL AND NOT isnan(v)")
    cell = [F.min("v").alias("low"), F.max("v").alias("high"), F.count("v").alias("n")]
    octaves = rows.groupBy("_p", "c", F.expr(OCTAVE_CELL).alias("cell")).agg(*cell)
    before = Window.partitionBy("_p", "c").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("n").over(before), F.lit(0)).alias("below")
    cells = stage(octaves.select("_p", "c", "low", "high", "n", below), "cells")

    sizes = cells.groupBy("_p", "c").agg(F.sum("n").alias("total"))
    shares = {i: [k / len(labels) for k in range(len(labels) + 1)] for i, (_, _, labels) in enumerate(bands)}
    ranks = " ".join(
        f"WHEN {i} THEN array({', '.join(f'{f}((total - 1) * {_number(q)})' for q in found for f in ('floor', 'ceil'))})"
        for i, found in shares.items()
    )
    wanted = sizes.selectExpr("_p", "c", "total", f"explode(array_distinct(CASE c {ranks} END)) AS rank")
    known = None
    while True:
        held = cells.join(wanted, ["_p", "c"]).where("rank >= below AND rank < below + n")
        value = "CASE WHEN rank = below OR low = high THEN low WHEN rank = below + n - 1 THEN high END AS v"
        held = stage(held.selectExpr("_p", "c", "total", "rank", "low", "high", "below", value), "ranks")
        found = held.where("v IS NOT NULL").select("_p", "c", "total", "rank", "v")
        known = found if known is None else known.union(found)
        wanted = held.where("v IS NULL").select("_p", "c", "total", "rank")
        if wanted.isEmpty():
            break
        # at most two ranks an edge, so a value's rows meet a handful of open cells
        opened = held.where("v IS NULL").select("_p", "c", "low", "high", "below").distinct()
        inside = rows.join(opened, ["_p", "c"]).where("v >= low AND v <= high")
        split = F.expr(f"least(floor((v - low) / (high - low) * {SPLITS}), {SPLITS - 1})")
        parts = inside.groupBy("_p", "c", "below", split.alias("cell")).agg(*cell)
        before = Window.partitionBy("_p", "c", "below").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        below = (F.col("below") + F.coalesce(F.sum("n").over(before), F.lit(0))).alias("below")
        cells = stage(parts.select("_p", "c", "low", "high", "n", below), "cells")

    at = known.groupBy("_p", "c").agg(
        F.max("total").alias("total"), F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at"))
    edges = [
        F.max(F.when(F.col("c") == i, F.array(*[F.expr(_between(q)) for q in found]))).alias(f"_e{i}")
        for i, found in shares.items()
    ]
    return at.groupBy("_p").agg(*edges)


def _between(share: float) -> str:
    """``_interpolate`` as SQL over the map of values by rank."""
    position = f"((total - 1) * {_number(share)})"
    low, high = f"at[floor({position})]", f"at[ceil({position})]"
    part = f"({position} - floor({position}))"
    return f"""CASE WHEN {part} = 0 OR {low} = {high} THEN {low} WHEN abs({low}) = double('inf') THEN {low}
        WHEN abs({high}) = double('inf') THEN {high}
        WHEN {part} < 0.5D THEN {low} + ({high} - {low}) * {part} ELSE {high} - ({high} - {low}) * (1 - {part}) END"""


def _edges(df: DataFrame, bands, method: str) -> dict[tuple[str, int], list[float] | None]:
    find = {"exact": exact_quantiles, "sketch": bracketed_quantiles, "approx": approximate_quantiles}[method]
    by_count: dict[int, list[str]] = {}
    for column, _, labels in bands:
        by_count.setdefault(len(labels), []).append(column)
    return {
        (column, n): cut
        for n, columns in by_count.items()
        for column, cut in find(df, columns, [k / n for k in range(n + 1)]).items()
    }


# Expressions are put together as SQL text: one call to the JVM instead of one per operator.
def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _number(value: float) -> str:
    return f"double('{value!r}')"


def _text(label: str) -> str:
    return "'" + label.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _band(column: str, limits: Sequence[str], results: Sequence[str]) -> Column:
    cases = [f"WHEN {_name(column)} <= {limit} THEN {result}" for limit, result in zip(limits, results)]
    return F.expr(f"CASE {' '.join(cases)} END")


def _stacked(df: DataFrame, values: Sequence[str], cells: Sequence[str] = ()) -> DataFrame:
    """(c, v) rows for all columns; with ``cells`` also the number of the open cell."""
    extra = [f", {cell} AS cell" for cell in cells] or [""] * len(values)
    items = [f"struct({i} AS c, {v} AS v{more})" for i, (v, more) in enumerate(zip(values, extra))]
    rows = df.selectExpr(f"inline(array({', '.join(items)}))")
    return rows.where("v IS NOT NULL AND NOT isnan(v)" + (" AND cell IS NOT NULL" if cells else ""))


def _accumulate(cells: list, below: int) -> list[_Cell]:
    """Cells in value order with the rows below each; cells that overlap become one."""
    merged: list[list] = []
    for low, high, rows in sorted(cells):
        if merged and low <= merged[-1][1]:
            merged[-1][1] = max(high, merged[-1][1])
            merged[-1][2] += rows
        else:
            merged.append([low, high, rows])
    result = []
    for low, high, rows in merged:
        result.append(_Cell(low, high, below, rows))
        below += rows
    return result


def _refine(
    df: DataFrame, values: Sequence[str], open_cells: dict[int, list[_Cell]], direct: bool
) -> dict[int, list[_Cell]]:
    """Split every open cell, or list its values when all of them are few."""
    numbered = [(i, n, c) for i, found in open_cells.items() for n, c in enumerate(found)]
    ranges = [
        f"{values[i]} BETWEEN {_number(c.low)} AND {_number(c.high)}" for i, _, c in numbered
    ]
    cells = []
    for k in range(len(values)):
        whens = [f"WHEN {r} THEN {n}" for r, (i, n, _) in zip(ranges, numbered) if i == k]
        cells.append(f"CASE {' '.join(whens)} END" if whens else "CAST(NULL AS INT)")
    rows = _stacked(df.where(" OR ".join(ranges)), values, cells)
    if direct:
        listed = rows.groupBy("c", "cell", "v").agg(F.count(F.lit(1)).alias("n")).toArrow()
        split = [(r["c"], r["cell"], r["v"], r["v"], r["n"]) for r in listed.to_pylist()]
    else:
        shares = [
            f"WHEN c = {i} AND cell = {n} "
            f"THEN (v - {_number(c.low)}) / {_number(c.high - c.low)}"
            for i, n, c in numbered
        ]
        part = F.expr(f"least(floor(CASE {' '.join(shares)} END * {SPLITS}), {SPLITS - 1})")
        grouped = rows.groupBy("c", "cell", part.alias("part"))
        found = grouped.agg(F.min("v"), F.max("v"), F.count("v")).collect()
        split = [(r[0], r[1], *r[-3:]) for r in found]
    parts: dict[tuple[int, int], list] = {}
    for i, n, *part in split:
        parts.setdefault((i, n), []).append(part)
    for i, n, c in numbered:
        if sum(part[2] for part in parts.get((i, n), ())) != c.rows:
            raise ChangedInputError(f"{c.rows} values from {c.low!r} to {c.high!r} were there in one pass, not in the next")
    return {
        i: [p for n, c in enumerate(found) for p in _accumulate(parts[i, n], c.below)]
        for i, found in open_cells.items()
    }


def _ranks(rows: int, probabilities: Sequence[float]) -> set[int]:
    positions = [(rows - 1) * p for p in probabilities] if rows else []
    return {rank for x in positions for rank in (math.floor(x), math.ceil(x))}


def _interpolate(known: dict, column: int, rows: int, probability: float) -> float:
    """Between the two neighbouring values, measured from the nearer one."""
    position = (rows - 1) * probability
    low, high = known[column, math.floor(position)], known[column, math.ceil(position)]
    share = position - math.floor(position)
    if share == 0 or low == high:
        return low
    if math.isinf(low) or math.isinf(high):
        return low if math.isinf(low) else high
    gap = high - low
    return low + gap * share if share < 0.5 else high - gap * (1 - share)
