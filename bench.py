"""Times the headline queries and prints one JSON line.

Every query is built and run to the end without keeping its result: once to warm up, then
``REPEATS`` times, and the median counts. ``--correlated`` compares the grouped window sums with
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from givingledger.functions.fiscal import WINDOW_COUNT
from givingledger.operators.donations import valued_donations
from givingledger.operators.giving import DONOR, with_giving
from givingledger.plans.catalog import SAMPLE_PARAMS, catalog
from givingledger.settings import SESSION_SETTINGS
from givingledger.sources.sample_views import donor_tables

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = 3
HEADLINES = (
    "lifetime_totals",
    "donor_status",
    "total_years_given",
    "fy_window_totals",
    "percent_changes",
    "donor_rollup",
    "contact_block",
    "donor_funds",
    "donor_notes",
    "school_averages",
    "campaign_columns",
    "ytd_total_all_donors",
    "donor_export",
)


def start_spark() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("givingledger-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    return spark


def seconds(build: Callable[[], DataFrame]) -> float:
    started = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def median_seconds(build: Callable[[], DataFrame]) -> float:
    seconds(build)
    return round(statistics.median(seconds(build) for _ in range(REPEATS)), 3)


def window_sums(spark: SparkSession) -> DataFrame:
    """Plain and valued sums of each donor and window, grouped."""
    tables = donor_tables(spark, FOLDER)
    return with_giving(tables.donors.select(DONOR), tables.donations, SAMPLE_PARAMS).select(
        DONOR, *[f"{kind}{back}" for kind in ("Donated", "Valued") for back in range(WINDOW_COUNT)]
    )


def window_sums_by_subqueries(spark: SparkSession) -> DataFrame:
    """The same, one correlated subquery per sum."""
    tables = donor_tables(spark, FOLDER)
    sums = [
        f"(SELECT coalesce(sum({column}), 0) FROM {{gifts}} g WHERE g.{DONOR} = d.{DONOR} "
        f"AND {window.covers('DonatedOn')}) AS {kind}{window.years_back}"
        for kind, column in {"Donated": "Amount", "Valued": "ValuedAmount"}.items()
        for window in SAMPLE_PARAMS.calendar.windows
    ]
    gifts = valued_donations(tables.donations)
    text = f"SELECT {DONOR}, {', '.join(sums)} FROM {{donors}} d"
    return spark.sql(text, donors=tables.donors, gifts=gifts)


def main() -> None:
    spark = start_spark()
    if "--correlated" in sys.argv:
        timed = {
            "window_sums": median_seconds(lambda: window_sums(spark)),
            "window_sums_by_subqueries": median_seconds(lambda: window_sums_by_subqueries(spark)),
        }
    else:
        timed = {
            name: median_seconds(lambda name=name: catalog()[name](spark, FOLDER))
            for name in HEADLINES
        }
    result = {
        "metric": "total time of the headline queries",
        "value": round(sum(timed.values()), 3),
        "unit": "sec",
        "queries": timed,
        "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
