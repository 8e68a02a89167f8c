"""Time the headline queries; prints one line of JSON.

The first round of every query warms up the JVM and is reported apart; the
value of a query is the median of the rounds after it.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from fareloom.contract import AMOUNT, DISTANCE, DURATION  # noqa: E402
from fareloom.operators.distribution import distribution  # noqa: E402
from fareloom.operators.profile import rule_report  # noqa: E402
from fareloom.plans import answers, registry  # noqa: E402
from fareloom.plans.medallion import Layers, refresh, refresh_partitions, unify_mixed  # noqa: E402
from fareloom.session import fresh_path  # noqa: E402
from fareloom.sources import landing  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
ROUNDS = int(os.environ.get("BENCH_ROUNDS", "3"))


def session() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("fareloom-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Without this, PySpark looks up the caller of every column expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # One process only: its own folder stands for the shared one.
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="fareloom-bench-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    return spark


def consume(frame) -> None:
    """Compute every row of a frame and keep none."""
    frame.write.format("noop").mode("overwrite").save()


def many_deliveries(spark: SparkSession) -> str:
    """The same trips in 240 small files, 24 for each fleet and month."""
    base = fresh_path(spark, "many")
    for name, frame in registry.fleet_frames(spark, SF_DIR).items():
        pickup = registry.FLEETS[name].native(["tpep_pickup_datetime"])[0]
        month = F.date_format(pickup, "yyyy-MM")
        entry = F.concat(F.lit(f"{name}_tripdata_"), month, F.lit(landing.SUFFIX))
        split = frame.withColumns({"entry": entry, "part": F.col("event_id") % 24})
        by_part = split.repartition(48, "entry", "part")
        by_part.write.partitionBy("entry", "part").parquet(f"{base}/{name}")
    return base


def ten_times(spark: SparkSession):
    """Ten copies of every trip."""
    return registry.trips(spark, SF_DIR).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(10))))


def cases(spark: SparkSession) -> dict:
    """What each name runs: from trip files, from a layer table, or from a view."""
    every = registry.all_queries()
    lake = registry.layer_tables(spark, SF_DIR)
    named = answers.catalogue(registry.PERIOD)
    layers = Layers()

    folder = registry.landing_folder(spark, SF_DIR)
    many = many_deliveries(spark)

    def ingested(base):
        """Listing and footers are read anew every time."""
        return landing.ingest(spark, landing.landing_entries(spark, base)).raw

    def files():
        return unify_mixed(ingested(folder))

    def consolidate():
        refresh(registry.scratch_lake(spark, "bench"), ingested(folder))

    standing = registry.scratch_lake(spark, "standing")
    refresh(standing, ingested(folder))

    def redelivered():
        """One month of every fleet comes again; the lake stands already."""
        again = ingested(folder).where(F.col("year_month") == registry.PERIOD.text)
        refresh_partitions(standing, again)

    def report(name, source):
        return lambda: named[name](source()).collect()

    def gold_table():
        return lake.read("gold")

    from_gold = ("q1_main", "q1_share", "q2_main", "q2_period", "top5_hours", "exec_summary")
    measured = [AMOUNT, DISTANCE, DURATION]
    return {
        "consolidation_4_layers": consolidate,
        "ingest_240_files": lambda: consume(ingested(many)),
        "gold_rollup_10x": lambda: consume(layers.gold_from(ten_times(spark))),
        "refresh_one_month": redelivered,
        "gold_from_files": lambda: consume(layers.gold_from(files())),
        "gold_from_silver": lambda: consume(layers.gold(lake.read("silver"))),
        "q1_main_from_files": report("q1_main", lambda: layers.gold_from(files())),
        "q2_main_from_files": report("q2_main", lambda: layers.gold_from(files())),
        **{f"{name}_from_gold": report(name, gold_table) for name in from_gold},
        "gold_rollup_events": lambda: consume(every["gold_rollup"](spark, SF_DIR)),
        "gold_rollup_lines": lambda: consume(every["gold_rollup_lines"](spark, SF_DIR)),
        "dq_report_bronze": lambda: rule_report(
            lake.read("bronze"), registry.all_rules()
        ).collect(),
        "dq_distribution_silver": lambda: distribution(lake.read("silver"), measured).collect(),
    }


def main() -> None:
    spark = session()
    rows = registry.read_events(spark, SF_DIR).count()
    first, later = {}, {}
    runs = cases(spark)
    for round_ in range(ROUNDS + 1):
        for name, run in runs.items():
            start = time.perf_counter()
            run()
            seconds = time.perf_counter() - start
            if round_ == 0:
                first[name] = round(seconds, 3)
            else:
                later.setdefault(name, []).append(seconds)
    queries = {name: round(median(seconds), 3) for name, seconds in later.items()}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "first_round": first,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "trips": rows,
                "consolidation_rows_per_sec": round(rows / queries["consolidation_4_layers"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
