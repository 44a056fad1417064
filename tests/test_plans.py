"""What the plans must look like for large data."""

from __future__ import annotations

import re
from contextlib import contextmanager

import pytest
from fixtures import params
from pyspark.sql import functions as F

from givingledger.operators.giving import donor_rollup, giving_history
from givingledger.operators.joins import lookup
from givingledger.operators.labels import title_totals
from givingledger.operators.peers import peer_averages
from givingledger.plans.catalog import SAMPLE_PARAMS, catalog
from givingledger.sources.sample_views import donor_tables

FOLDER = "/root/testdata/sf0.001"
NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@contextmanager
def settings(spark, values):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def planned(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def executed(frame):
    """The final plan of adaptive execution."""
    frame.collect()
    return planned(frame).split("== Initial Plan ==")[0]


def scans(plan, column):
    return [line for line in plan.splitlines() if "FileScan" in line and column in line]


@pytest.mark.parametrize("name", list(catalog()))
def test_no_python_in_any_plan(spark, name):
    plan = planned(catalog()[name](spark, FOLDER))
    assert not re.search(r"Python|Pandas|MapInArrow|ExistingRDD|CartesianProduct", plan)


def test_date_bounds_reach_the_scan(spark):
    for name in ("donations_in_window", "school_prev_fy_amounts", "ytd_total_all_donors"):
        frame = catalog()[name](spark, FOLDER)
        text = frame._sc._jvm.PythonSQLUtils.explainString(
            frame._jdf.queryExecution(), "formatted"
        )
        pushed = [line for line in text.splitlines() if "PushedFilters" in line]
        assert any(
            "GreaterThanOrEqual(o_orderdate" in line and "LessThanOrEqual(o_orderdate" in line
            for line in pushed
        ), name


def test_only_needed_columns_are_read(spark):
    plan = planned(catalog()["donor_funds"](spark, FOLDER))
    (scan,) = scans(plan, "o_orderkey")
    assert "o_orderdate" not in scan
    plan = planned(catalog()["lifetime_totals"](spark, FOLDER))
    assert "InKindFairMarketValue" not in plan
    assert "Last" not in plan


def test_donations_are_read_once_per_purpose(spark):
    with settings(spark, NO_BROADCAST):
        assert len(scans(planned(catalog()["donor_rollup"](spark, FOLDER)), "o_orderkey")) == 1
        assert len(scans(executed(catalog()["school_averages"](spark, FOLDER)), "o_orderkey")) == 1
        # Rollup, labels, campaign, current year and last year; and the notes' ids, then their texts.
        plan = executed(catalog()["donor_export"](spark, FOLDER))
        assert len(scans(plan, "o_orderkey")) == 7


def test_only_single_rows_are_broadcast_by_hint(spark):
    with settings(spark, NO_BROADCAST):
        plan = planned(catalog()["donor_export"](spark, FOLDER))
    assert "BroadcastHashJoin" not in plan
    # Campaign (of two parts), current year, peer averages (of two, one with a further part).
    assert plan.count("BroadcastNestedLoopJoin") == 6


def test_history_is_narrow_and_spread(spark):
    """The first shuffle is by donor, window and year; the wide row exists only after the second."""
    tables = donor_tables(spark, FOLDER)
    plan = planned(donor_rollup(giving_history(tables.donations, SAMPLE_PARAMS)))
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 2
    assert "GivingYear" not in shuffles[0]
    assert "YearsBack" in shuffles[1] and "GivingYear" in shuffles[1]


def test_windows_without_partition_see_few_rows(spark):
    """Only the coarsest ranges of the peer averages are brought together."""
    tables = donor_tables(spark, FOLDER)
    plan = planned(peer_averages(tables.donations, SAMPLE_PARAMS))
    single = [line for line in plan.splitlines() if "Exchange SinglePartition" in line]
    windows = [line for line in plan.splitlines() if re.search(r"[-:] Window \[", line)]
    assert len(windows) == 4
    # The totals (used twice), the sum of the largest, and the window over Range1.
    assert len(single) == 4


@pytest.mark.parametrize("hot", ["known", "unknown"])
def test_frequent_keys_are_split(spark, hot):
    """A key that holds most rows, or no key at all, does not end up in one task."""
    few = 2 if hot == "known" else None
    values = {
        **NO_BROADCAST,
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    with settings(spark, values):
        rows = spark.range(0, 200_000, 1, 8).select(
            F.col("id").alias("donor"),
            F.when(F.col("id") % 3 > 0, F.lit(few)).otherwise(F.col("id") % 500).alias("key"),
        )
        table = spark.range(500).groupBy(F.col("id").alias("key")).agg(F.max("id").alias("name"))
        joined = lookup(rows, table, "key", "donor").withColumn("part", F.spark_partition_id())
        joined = joined.select("donor", "key", "name", "part")
        sizes = [row["count"] for row in joined.groupBy("part").count().collect()]
        assert sum(sizes) == 200_000
        assert joined.filter(~F.col("key").eqNullSafe(F.col("name"))).count() == 0
        plan = executed(joined)
        assert ("skew=true" in plan) == (hot == "known")
        parts = joined.groupBy("part").count().agg(F.max("count")).first()[0]
        assert parts < 100_000


def test_gifts_to_one_fund_are_split(spark):
    values = {
        **NO_BROADCAST,
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    with settings(spark, values):
        gifts = spark.range(0, 300_000, 1, 8).selectExpr(
            "id AS DonorProfileID",
            "CAST(1 AS decimal(19,4)) AS Amount",
            "CASE WHEN id % 3 > 0 THEN 0 ELSE id % 2000 END AS FundID",
        )
        funds = spark.range(2000).selectExpr("id AS FundID", "concat('Fund ', id) AS Title")
        totals = title_totals(gifts, {"Funds": ("FundID", funds)})
        assert totals.groupBy().sum("Donated").first()[0] == 300_000
        assert "skew=true" in executed(totals)


def test_one_donor_with_most_gifts(spark):
    """History rows of a donor are bounded by years and windows, however many gifts there are."""
    gifts = spark.range(100_000).selectExpr(
        "'d' AS DonorProfileID",
        "CAST(id % 100 AS decimal(19,4)) AS Amount",
        "timestamp_ntz'2014-07-01' + make_dt_interval(CAST(id % 3600 AS int)) AS DonatedOn",
        "id % 2 = 0 AS IsStock",
        "false AS InKind",
        "CAST(NULL AS decimal(19,4)) AS InKindFairMarketValue",
        "CAST(NULL AS decimal(19,4)) AS StockFairMarketValue",
    )
    history = giving_history(gifts, params())
    assert history.count() < 50
    row = donor_rollup(history).first()
    assert row.Donated == sum(n % 100 for n in range(100_000))
    assert row.Stock == 50_000


@pytest.mark.parametrize("name", ["donor_rollup", "donor_status", "first_gift", "largest_gift"])
def test_gifts_are_not_sorted_before_they_are_combined(spark, name):
    assert "SortAggregate" not in planned(catalog()[name](spark, FOLDER))
