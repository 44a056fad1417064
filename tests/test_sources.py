"""Readers and writers."""

from __future__ import annotations

import pytest
from fixtures import donor, frame, gift, make_tables, params
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from givingledger.names import EMPTY_TEXT_COLUMNS, EXPORT_COLUMNS, ZERO_COLUMNS
from givingledger.operators.campaign import campaign_summary
from givingledger.plans.export import donor_export
from givingledger.sources.donor_ids import donor_ids_from_documents, read_donor_ids
from givingledger.sources.sinks import SINK_FORMATS, write_export
from givingledger.sources.tables import SCHEMAS, ingest_tables, read_raw_table, read_tables, table_schema


@pytest.mark.parametrize(
    ("document", "expected"),
    [
        ("<GuidList><Guid> AB </Guid>\n<Guid>cd</Guid></GuidList>", ["ab", "cd"]),
        ("<GuidList><Guid>one</Guid></GuidList>", ["one"]),
        ("<GuidList></GuidList>", []),
        ("<GuidList><Guid></Guid></GuidList>", [None]),
        ("<Other><Guid>ab</Guid></Other>", []),
        (None, []),
    ],
)
def test_both_forms_of_id_lists_agree(spark, tmp_path, document, expected):
    documents = spark.createDataFrame([(document,)], "Xml string")
    ids = donor_ids_from_documents(documents, "Xml")
    assert [row.ProfileID for row in ids.collect()] == expected
    (tmp_path / "ids.xml").write_text(document or "")
    ids = read_donor_ids(spark, str(tmp_path))
    assert [row.ProfileID for row in ids.collect()] == expected


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_tables_round_trip(spark, tmp_path, file_format):
    rows = {
        "donors": [donor("D1", CalculatedGivingName="Ann")],
        "donations": [gift(5, params().fiscal_start, key=" d1 ")],
        "donor_links": [{"DonorProfileID": "d1", "ParentID": "P", "IsDefault": True}],
    }
    for name in SCHEMAS:
        table = frame(spark, name, rows.get(name, []))
        if "IsDefault" in table.columns and name != "phone_links":
            table = table.withColumnRenamed("IsDefault", "Default")
        if table.columns[1:]:  # in another order, and with a column that the export does not use
            table = table.select(F.lit("x").alias("Extra"), *reversed(table.columns))
        write_export(table, f"{tmp_path}/{name}", file_format)
    ingest_tables(spark, str(tmp_path), f"{tmp_path}/plain", file_format)
    tables = read_tables(spark, f"{tmp_path}/plain")
    for name in SCHEMAS:
        assert getattr(tables, name).schema.names == table_schema(name).names
    assert tables.donor_links.collect() == [("d1", "p", True, None)]
    (row,) = donor_export(tables, params()).collect()
    assert (row.DonorProfileID, row.LifetimeDonatedAmount) == ("d1", 5)
    with pytest.raises(AttributeError):
        tables.unknown  # noqa: B018


def test_missing_column_is_an_error(spark, tmp_path):
    write_export(frame(spark, "users", []).drop("UserName"), f"{tmp_path}/users", "csv")
    with pytest.raises(AnalysisException):
        read_raw_table(spark, str(tmp_path), "users", "csv").collect()


def test_campaign_filter_reaches_the_scan(spark, tmp_path):
    for name in SCHEMAS:
        frame(spark, name, []).write.parquet(f"{tmp_path}/raw/{name}")
    ingest_tables(spark, f"{tmp_path}/raw", f"{tmp_path}/plain")
    tables = read_tables(spark, f"{tmp_path}/plain")
    raised = campaign_summary(tables.campaigns, tables.donations, params(campaign_id="C1"))
    plan = raised._jdf.queryExecution().toString()
    assert plan.count("EqualTo(DonationCampaignID,c1)") >= 2


@pytest.mark.parametrize("file_format", SINK_FORMATS)
def test_export_can_be_written(spark, tmp_path, file_format):
    export = donor_export(make_tables(spark, donors=[donor()]), params())
    path = f"{tmp_path}/{file_format}"
    write_export(export, path, file_format)
    reader = spark.read.option("header", True) if file_format == "csv" else spark.read
    written = reader.format(file_format).load(path)
    assert written.count() == 1
    assert set(written.columns) <= set(EXPORT_COLUMNS)
    with pytest.raises(ValueError):
        write_export(export, path, "xlsx")


def test_export_columns(spark):
    export = donor_export(make_tables(spark, donors=[donor()]), params())
    assert export.columns == list(EXPORT_COLUMNS)
    assert len(EXPORT_COLUMNS) == len(set(EXPORT_COLUMNS)) == 126
    assert len(EMPTY_TEXT_COLUMNS) + len(ZERO_COLUMNS) == 34
    row = export.first().asDict()
    assert all(row[name] == "" for name in EMPTY_TEXT_COLUMNS)
    assert all(row[name] == 0 for name in ZERO_COLUMNS)
    assert row["CurrentDate"] == "01/15/2024"
