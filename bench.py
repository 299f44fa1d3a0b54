"""Time the headline queries; prints one JSON line.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]. Each query is
written to the noop sink, so all of its rows are computed. ``queries`` holds the better of
two runs and ``first_run`` the first, which also pays for code generation and starting
Python workers. ``BUILD`` starts from the raw tables. ``store_panel_and_serving`` then builds
and writes the panel and the serving panel once; ``ASK`` reads those, as a dashboard does.
"""

from __future__ import annotations

import json
import os
import sys
import time

from edupanel.session import get_spark
from workload import standin
from workload.registry import QUERIES

BUILD = (
    "normalize_name", "search_name", "scan_header_offset", "clean_gdp", "clean_score",
    "clean_projects", "clean_distortion", "clean_territory", "build_panel",
)
ASK = (
    "serving_panel", "band_quartile_population", "kpi_overview", "rank_top_score",
    "impact_score", "impact_variation", "context_by_segment", "history_series",
    "detail_table", "map_layer", "flag_by_year", "score_by_gdp_flag",
    "score_by_size_gdp_flag", "csv_export",
)


def run(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = get_spark(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    best: dict[str, float] = {}
    first: dict[str, float] = {}

    def time_all(names) -> None:
        for name in names:
            first[name] = run(spark, sf_dir, name)
            best[name] = min(first[name], run(spark, sf_dir, name))

    chosen = sys.argv[1:]
    time_all(n for n in BUILD if not chosen or n in chosen)
    start = time.perf_counter()
    standin.stored_serving(spark, sf_dir)
    stored = "store_panel_and_serving"
    first[stored] = best[stored] = round(time.perf_counter() - start, 3)
    time_all(n for n in ASK if not chosen or n in chosen)
    print(json.dumps({
        "metric": "total time of the headline queries",
        "value": round(sum(best.values()), 3),
        "unit": "sec",
        "queries": best,
        "first_run": first,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
