"""Benchmark the headline queries; print one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_RUNS`` (timed runs per query, default 3), ``BENCH_FACTOR``
(default 1): so many copies of the growing tables, with keys of their own, are
written to a temporary folder and measured instead (20 copies of sf0.1 are
3 million events and orders, the size of the published incident table).

Each query runs once untimed first (JVM warm-up, and derived input files
such as the CSV / JSON sources are written then, as the reference's input
files exist before its runs).  The timed span of a run is building the
DataFrame (with the small site table's read of the nearest-site search) plus
``collect()``; the reported time is the median of the runs.  Each query is
compared with a baseline row of the same kind of source; ``input_rows`` are
the rows of its growing input, ``sec_per_million_rows`` the time over them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from beatwise.plans.registry import QUERIES  # noqa: E402
from beatwise.session import get_session  # noqa: E402

HEADLINE = {
    "daypart_share_csv": "Q1 DataFrame, CSV",
    "daypart_share_udf_csv": "Q1 DataFrame + Python UDF, CSV",
    "daypart_share_text": "Q1 RDD, text",
    "daypart_share_parquet": "Q1 DataFrame, Parquet",
    "top_months_csv": "Q2 DataFrame, CSV",
    "top_months_sql_csv": "Q2 SQL, CSV",
    "income_per_person": "Q3 DataFrame (default, broadcast hash)",
    "income_from_text": "Q3 RDD",
    "income_join_merge": "Q3 forced sort-merge",
    "income_join_shuffle_hash": "Q3 forced shuffled hash",
    "station_load_csv": "Q4 (DataFrame), CSV",
    "station_load": "none (Parquet)",
    "station_load_sql": "none (SQL form, Parquet)",
    "station_load_suppliers": "none (sites grow with the data)",
    "daypart_share_quoted": "Q1 RDD, text (quoted line breaks)",
    "income_per_person_ranges": "Q3 DataFrame (documents by byte ranges)",
}
# Table whose rows a query's work grows with, by the name's first word.
GROWS_WITH = {"daypart": "events", "top": "orders", "income": "customer", "station": "customer"}


# Keys of the growing tables, and the table that numbers them.
KEYS = {"events": {"event_id": "events"}, "orders": {"o_orderkey": "orders", "o_custkey": "customer"},
        "customer": {"c_custkey": "customer"}}


def copied(spark, sf_dir: str, factor: int) -> str:
    """A folder with ``factor`` copies of the growing tables and the others as they are."""
    out = tempfile.mkdtemp(prefix="beatwise-bench-")
    spans = {}
    for table, keys in KEYS.items():
        own = next(k for k, numbered in keys.items() if numbered == table)
        spans[table] = spark.read.parquet(f"{sf_dir}/{table}.parquet").agg(F.max(own)).first()[0] + 1
    for table in (*KEYS, "supplier", "nation"):
        rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        if table in KEYS:
            names = rows.columns
            rows = rows.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(factor - 1))))
            for key, numbered in KEYS[table].items():
                rows = rows.withColumn(key, F.col(key) + F.col("_copy") * spans[numbered])
            rows = rows.select(*names)
        rows.repartition(8).write.parquet(f"{out}/{table}.parquet")
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_session(f"local[{cpus}]", app_name="beatwise-bench", shuffle_partitions=cpus,
                        **{"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    factor = int(os.environ.get("BENCH_FACTOR", "1"))
    named, sf_dir = sf_dir, copied(spark, sf_dir, factor) if factor > 1 else sf_dir
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in HEADLINE:
        query = QUERIES[name]
        rows[name] = len(query(spark, sf_dir).collect())
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            query(spark, sf_dir).collect()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    sizes = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in set(GROWS_WITH.values())}
    inputs = {name: sizes[GROWS_WITH[name.split("_")[0]]] for name in HEADLINE}
    spark.stop()
    sf = os.path.basename(named.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total_median_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "input_rows": inputs,
        "sec_per_million_rows": {n: round(times[n] * 1e6 / inputs[n], 2) for n in HEADLINE},
        "baseline_rows": HEADLINE,
        "runs": runs,
        "cpus": cpus,
        "factor": factor,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }))


if __name__ == "__main__":
    main()
