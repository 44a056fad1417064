"""The fifteen base tables: schemas and readers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from givingledger.functions.money import MONEY
from givingledger.sources.donor_ids import plain_id

# Only the columns the export uses. Columns ending in ID (and CreatedBy) hold GUID text.
SCHEMAS = {
    "donors": "DonorProfileID string, CalculatedGivingName string, CalculatedGreeting string, "
    "IsDonorAdvisedFund boolean, OverrideAddressID string, OverridePhoneNumberID string, "
    "OverrideEmailAddressID string",
    "donations": f"DonorProfileID string, Amount {MONEY}, DonatedOn timestamp_ntz, "
    f"IsStock boolean, InKind boolean, InKindFairMarketValue {MONEY}, "
    f"StockFairMarketValue {MONEY}, DonationCampaignID string, FundID string, "
    "DonationAppealID string",
    "donor_links": "DonorProfileID string, ParentID string, IsDefault boolean, "
    "ParentSystemClassID int",
    "companies": "CompanyID string, OrganizationType string",
    "addresses": "AddressID string, SalutationFirstname string, SalutationLastname string, "
    "FamilySalutation string, Address1 string, Address2 string, City string, Region string, "
    "PostalCode string, CountryCode string",
    "address_links": "ParentID string, AddressID string, IsDefault boolean",
    "phones": "PhoneNumberID string, Number string",
    "phone_links": "PhoneNumberID string, ParentID string, IsDefault boolean",
    "emails": "EmailAddressID string, ParentID string, Email string",
    "campaigns": "DonationCampaignID string, Title string, GoalAmount double",
    "funds": "FundID string, Title string",
    "appeals": "DonationAppealID string, Title string",
    "notes": "ParentID string, CreatedBy string, NoteText string, Created timestamp_ntz",
    "users": "UserID string, UserName string",
    "giving_levels": f"DonationTemplateID string, Amount {MONEY}, Title string, Active boolean",
}


class DonorTables:
    """The base tables as attributes, named as in ``SCHEMAS``; each is loaded when first used.

    ``guids`` says that all ids are known to be GUID text in its usual form, in lower case.
    ``load_parts`` gives a table as parts that share no donor, where it is stored so.
    """

    def __init__(
        self,
        load: Callable[[str], DataFrame],
        guids: bool = False,
        load_parts: Callable[[str], list[DataFrame]] | None = None,
    ) -> None:
        self._load = load
        self._load_parts = load_parts
        self.guids = guids

    def parts(self, name: str) -> list[DataFrame]:
        """The table in parts that share no donor; work by donor can be done part by part.

        Rows without a donor may be in none of them.
        """
        return [getattr(self, name)] if self._load_parts is None else self._load_parts(name)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        table = self._load(name)
        setattr(self, name, table)
        return table


def table_schema(name: str) -> StructType:
    return StructType.fromDDL(SCHEMAS[name])


def with_plain_ids(table: DataFrame) -> DataFrame:
    """GUID text trimmed and in lower case, so that equality ignores case."""
    return table.select(
        *[
            plain_id(F.col(field.name)).alias(field.name)
            if isinstance(field.dataType, StringType)
            and (field.name.endswith("ID") or field.name == "CreatedBy")
            else F.col(field.name)
            for field in table.schema.fields
        ]
    )


def read_raw_table(
    spark: SparkSession, root: str, name: str, file_format: str = "parquet"
) -> DataFrame:
    """One base table as it comes, from ``root/name``, with ids made plain.

    Columns are found by name, in any order and among others; a missing one is an error. A stored
    column ``Default`` is read as ``IsDefault``.
    """
    reader = spark.read.format(file_format)
    if file_format == "csv":
        reader = reader.option("header", True)
    stored = reader.load(f"{root}/{name}")
    if "Default" in stored.columns and "IsDefault" not in stored.columns:
        stored = stored.withColumnRenamed("Default", "IsDefault")
    wanted = table_schema(name)
    return with_plain_ids(
        stored.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in wanted])
    )


def ingest_tables(
    spark: SparkSession, source: str, target: str, file_format: str = "parquet"
) -> None:
    """Writes the base tables with plain ids, once, so that later reads can filter in the scan."""
    for name in SCHEMAS:
        read_raw_table(spark, source, name, file_format).write.parquet(f"{target}/{name}")


def read_tables(spark: SparkSession, root: str) -> DonorTables:
    """The tables that :func:`ingest_tables` wrote."""
    return DonorTables(
        lambda name: spark.read.schema(table_schema(name)).parquet(f"{root}/{name}")
    )
