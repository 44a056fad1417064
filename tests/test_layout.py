"""Tables laid out by donor, ids as numbers, listed donors, late note texts: same rows, and plans fit for large tables."""

from __future__ import annotations

import re
import types
from decimal import Decimal
from functools import reduce

import pytest
from fixtures import donor, frame, gift, make_tables, params
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from test_plans import FOLDER, NO_BROADCAST, executed, planned, settings

from givingledger.functions.ids import guid_halves, guid_of, place_of, tag_of, tagged
from givingledger.functions.money import percent_change
from givingledger.operators import contacts
from givingledger.operators.filters import keep_listed
from givingledger.operators.giving import donor_rollup, giving_history
from givingledger.operators.labels import gift_labels, gift_purposes, title_totals
from givingledger.operators.notes import single_notes, with_notes
from givingledger.plans.catalog import SAMPLE_PARAMS, catalog
from givingledger.plans.export import donor_export
from givingledger.sources import layout
from givingledger.sources.donor_ids import read_donor_ids
from givingledger.sources.layout import lay_out_tables, read_layout
from givingledger.sources.sample_views import donor_tables, guid_tables
from givingledger.sources.scratch import shared_folder
from givingledger.sources.tables import DonorTables


@pytest.fixture(scope="module")
def laid(spark, tmp_path_factory):
    """Sample tables with GUID text, gifts of one donor tripled, laid out."""
    plain = guid_tables(spark, FOLDER)
    hot = plain.donations.filter(F.col("DonorProfileID").isNotNull()).agg(F.min("DonorProfileID")).first()[0]
    more = plain.donations.withColumn("DonorProfileID", F.lit(hot)).limit(700)
    tables = DonorTables(lambda name: plain.donations.unionByName(more) if name == "donations" else getattr(plain, name), guids=True)
    root = f"file://{tmp_path_factory.mktemp('laid')}/tables"
    return tables, lay_out_tables(tables, spark, root, "laid_", buckets=8), root, hot


def test_layout_holds_the_same_rows(spark, laid):
    tables, stored, root, hot = laid
    assert stored.guids
    for name in ("donations", "donor_links", "notes", "users"):
        assert sorted(map(str, getattr(stored, name).collect())) == sorted(map(str, getattr(tables, name).collect()))
    usual, frequent = stored.parts("donations")
    assert usual.filter((F.col("DonorProfileID") == hot) | F.col("DonorProfileID").isNull()).isEmpty()
    assert 0 < frequent.select("DonorProfileID").distinct().count() <= 33
    run = SAMPLE_PARAMS.__class__(**{**SAMPLE_PARAMS.__dict__, "campaign_id": None})
    expected = donor_export(tables, run)
    found = donor_export(stored, run)
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()


def test_layout_can_be_registered_again(spark, laid):
    _, stored, root, _ = laid
    rows = sorted(map(str, stored.parts("donations")[0].collect()))
    again = read_layout(spark, root, "again_")
    assert sorted(map(str, again.parts("donations")[0].collect())) == rows
    assert "Bucketed: true" in planned(donor_rollup(giving_history(again.parts("donations")[0], SAMPLE_PARAMS)))


def test_buckets_follow_the_data(spark, tmp_path, monkeypatch):
    """Ten times the gifts, or much longer notes, need more buckets: one of them never holds more than its share."""
    gifts = [gift(n, key=str(d)) for n in range(1, 11) for d in range(40)]
    few, many = (make_tables(spark, donors=[donor(str(d)) for d in range(40)], donations=g) for g in (gifts[:40], gifts))
    assert layout.buckets_for(few) == layout.buckets_for(make_tables(spark)) == layout.LEAST_BUCKETS
    monkeypatch.setattr(layout, "ROWS_IN_BUCKET", 25)
    assert (layout.buckets_for(few), layout.buckets_for(many)) == (8, 16)
    stored = lay_out_tables(many, spark, f"file://{tmp_path}/many", "many_")
    assert spark.read.parquet(f"file://{tmp_path}/many/{layout.ABOUT}").first()["Buckets"] == 16
    found, expected = donor_export(stored, params()), donor_export(many, params())
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
    monkeypatch.setattr(layout, "TEXT_IN_BUCKET", 100)
    noted = few.notes.unionByName(spark.createDataFrame([("1", "1", "x" * 900, None), ("2", None, None, None)], few.notes.schema))
    long = DonorTables(lambda name: noted if name == "notes" else getattr(few, name))
    assert layout.buckets_for(long) == 10


def test_gifts_in_buckets_are_not_shuffled(spark, laid):
    _, stored, _, _ = laid
    with settings(spark, NO_BROADCAST):
        gifts = stored.parts("donations")[0]
        assert "Exchange" not in planned(donor_rollup(giving_history(gifts, SAMPLE_PARAMS)))
        purposes = gift_purposes(stored)
        plan = planned(title_totals(gifts, purposes))
        below_first = plan[plan.index("DonationAppealID", plan.rindex("Exchange")) :] if "Exchange" in plan else plan
        assert len(re.findall(r"Exchange hashpartitioning\(DonorProfileID", below_first)) == 0
        assert "Exchange" not in planned(contacts.default_parent(stored.parts("donor_links")[0], True))
        plan = planned(donor_export(stored, SAMPLE_PARAMS))
        for line in plan.splitlines():  # no shuffle of gifts in buckets: what lies on their scan is an aggregate
            assert not ("Exchange" in line and "DonatedOn" in line)
        assert plan.count("Bucketed: true") >= 4
        gift_labels(gifts, purposes).collect()


def test_layout_of_other_ids_and_of_empty_tables(spark, tmp_path):
    rows = {"donors": [donor("x"), donor("y")], "donations": [gift(5, params().fiscal_start, key="x")] * 3,
            "donor_links": [{"DonorProfileID": "x", "ParentID": "P", "IsDefault": True}]}
    tables = make_tables(spark, **rows)
    stored = lay_out_tables(tables, spark, f"file://{tmp_path}/a", "plain_", buckets=4)
    assert not stored.guids
    assert {r.DonorProfileID: r.LifetimeDonatedAmount for r in donor_export(stored, params()).collect()} == {"x": 15, "y": None}
    empty = lay_out_tables(make_tables(spark), spark, f"file://{tmp_path}/b", "empty_", buckets=4)
    assert donor_export(empty, params()).collect() == []


def test_ids_as_numbers(spark):
    guids = [f"{a:08x}-{b:04x}-{a % 7:04x}-{b:04x}-{a * 3 + b:012x}" for a in (0, 1, 2**31, 2**32 - 1) for b in (0, 9, 65535)]
    table = spark.createDataFrame([(g,) for g in [*guids, None]], "G string")
    high, low = guid_halves(F.col("G"))
    halves = table.select("G", high.alias("High"), low.alias("Low"))
    assert halves.filter(~guid_of(F.col("High"), F.col("Low")).eqNullSafe(F.col("G"))).isEmpty()
    ordered = [r.G for r in halves.filter("G IS NOT NULL").orderBy("High", "Low").collect()]
    assert ordered == sorted(guids)
    pairs = [(p, t) for p in (Decimal(0), Decimal(5), Decimal(2**64 - 1), None) for t in (None, -(2**31), -1, 0, 7, 2**31 - 1)]
    table = spark.createDataFrame(pairs, "P decimal(20,0), T int").selectExpr("P", "T", f"{tagged('P', 'T')} AS N")
    found = table.selectExpr("P", "T", "N", f"{place_of('N')} AS P2", f"{tag_of('N')} AS T2").orderBy("N").collect()
    assert all((r.P, r.T) == (r.P2, r.T2) for r in found)
    assert [(r.P, r.T) for r in found] == pairs


def test_default_parent_is_the_same_by_numbers(spark):
    guids = [f"0000000{a}-0000-4000-8000-00000000000{b}" for a in range(3) for b in range(3)]
    rows = [{"DonorProfileID": f"d{i % 9}", "ParentID": None if i % 4 == 0 else guids[i * 7 % 9], "IsDefault": i % 5 > 0,
             "ParentSystemClassID": None if i % 6 == 0 else 3 - i % 7} for i in range(60)]
    links = frame(spark, "donor_links", rows)
    by_text = sorted(map(str, contacts.default_parent(links).collect()))
    assert sorted(map(str, contacts.default_parent(links, guids=True).collect())) == by_text
    numbers = links.withColumn("ParentID", F.substring("ParentID", -1, 1).cast("long"))
    as_text = numbers.withColumn("ParentID", F.col("ParentID").cast("string"))
    expected = sorted(map(str, contacts.default_parent(as_text).withColumn("ParentID", F.col("ParentID").cast("long")).collect()))
    assert sorted(map(str, contacts.default_parent(numbers).collect())) == expected


@pytest.mark.parametrize("name", ["default_parent", "contact_block", "default_parent_guid", "parent_contacts_guid"])
def test_ids_are_not_sorted(spark, name):
    assert "SortAggregate" not in planned(catalog()[name](spark, FOLDER))


def test_note_texts_move_once(spark, tmp_path):
    tables = donor_tables(spark, FOLDER)
    with settings(spark, NO_BROADCAST):
        assert "SortAggregate" not in executed(with_notes(tables.donors.select("DonorProfileID"), tables.notes, tables.users))
        tables.notes.write.mode("overwrite").parquet(path := f"file://{tmp_path}/notes")
        lines = planned(single_notes(spark.read.parquet(path), tables.users)).splitlines()
        # Below the scan that has the text there is one shuffle above; the other scans read ids.
        assert sum("FileScan" in line and "NoteText" in line for line in lines) == 1
        assert sum("FileScan" in line for line in lines) >= 3


def test_listed_gifts_by_semi_join(spark):
    tables = donor_tables(spark, FOLDER)
    ids = spark.range(3).select(F.col("id").alias("ProfileID"))
    quick = {**NO_BROADCAST, "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
             "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    with settings(spark, quick):
        listed = keep_listed(tables.donations, ids.filter("ProfileID > 0"))
        plan = planned(listed)
        assert "LeftSemi" in plan and "LeftOuter" not in plan and "might_contain" in plan
        done = executed(listed)
        assert "Union" not in done and "BroadcastNestedLoopJoin" not in done  # the branch for an empty list was dropped
    assert keep_listed(tables.donations, ids.limit(0)).count() == tables.donations.count()
    nothing = spark.createDataFrame([(None,), ("",), (" ",)], "ProfileID string")
    assert keep_listed(tables.donors.withColumn("DonorProfileID", F.col("DonorProfileID").cast("string")), nothing).isEmpty()


def test_long_id_lists_are_split(spark, tmp_path):
    ids = [f"{i:036d}" for i in range(60_000)]
    text = "<?xml version='1.0'?>\n<!-- ids <Other> -->\n<GuidList a='1'>\n" + "\n".join(f"  <Guid>{i}</Guid>" for i in ids) + "<Guid/><Guid x='1'> A </Guid>\n</GuidList>"
    (tmp_path / "ids.xml").write_text(text)
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "300000", "spark.sql.files.openCostInBytes": "0"}):
        found = read_donor_ids(spark, str(tmp_path))
        assert found.rdd.getNumPartitions() > 4
        assert sorted(r.ProfileID or "" for r in found.collect()) == sorted([*ids, "", "a"])


def test_other_elements_in_id_lists(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<Other><GuidList/><Guid>ab</Guid><Guid>cd</Guid></Other>")
    assert read_donor_ids(spark, str(tmp_path)).collect() == []
    (tmp_path / "b.xml").write_text("<GuidList><Guid>ab</Guid><X><Guid>cd</Guid></X></GuidList>")
    with pytest.raises(PySparkException, match="other elements"):
        read_donor_ids(spark, str(tmp_path)).collect()


def test_extreme_percent_changes(spark):
    pairs = [("900000000000000", "0.0001"), ("-900000000000000", "0.0001"), ("1", "3"), ("-1", "3"), ("0", "0"), ("90000000000.5", "0.0003"),
             ("89999999999.9", "-0.0001"), ("9999999999999999999999999", "7")]
    table = spark.createDataFrame([tuple(map(Decimal, p)) for p in pairs], "n decimal(29,4), b decimal(29,4)")
    for row, (new, base) in zip(table.selectExpr(f"{percent_change('n', 'b')} AS p").collect(), pairs, strict=True):
        n, b = (int(Decimal(x) * 10000) for x in (new, base))
        whole = None if not b else abs((n - b) * 10000) // abs(b) * (1 if (n - b) * b >= 0 else -1)
        assert row.p == (None if whole is None else Decimal(f"{whole}E-2")), (new, base)
    beyond = spark.createDataFrame([(Decimal("9" * 25), Decimal("0.0001"))], "n decimal(29,4), b decimal(29,4)")
    with pytest.raises(PySparkException, match="cannot be represented"):
        beyond.selectExpr(percent_change("n", "b")).collect()


def test_label_rows_before_the_split(spark):
    """Gifts of one donor to the same campaign, fund and appeal are one row before they are split by purpose."""
    gifts = spark.range(9000).selectExpr("id % 3 AS DonorProfileID", "CAST(1 AS decimal(19,4)) AS Amount", "id % 2 AS DonationCampaignID",
                                         "id % 3 AS FundID", "CAST(NULL AS bigint) AS DonationAppealID")
    titles = spark.range(3).selectExpr("id AS DonationCampaignID", "id AS FundID", "id AS DonationAppealID", "'t' || id AS Title")
    purposes = {name: (key, titles.select(key, "Title")) for name, key in (("C", "DonationCampaignID"), ("F", "FundID"), ("A", "DonationAppealID"))}
    totals = title_totals(gifts, purposes)
    plan = planned(totals)
    assert plan[plan.index("Generate explode") :].count("HashAggregate(keys=[DonorProfileID") == 2
    assert totals.groupBy("Purpose").sum("Donated").orderBy("Purpose").collect() == [("C", 9000), ("F", 9000)]


def test_a_cluster_needs_a_shared_folder():
    session = types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda *_: None), sparkContext=types.SimpleNamespace(master="spark://a:7077"))
    with pytest.raises(ValueError, match="checkpoint.dir"):
        shared_folder(session)
    session.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(ValueError):
        shared_folder(session)


def test_parts_default_to_the_table(spark):
    tables = make_tables(spark)
    assert reduce(DataFrame.unionByName, tables.parts("donations")).columns == tables.donations.columns
