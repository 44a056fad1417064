"""The base tables derived from the sample star schema (customer, orders, supplier, ...).

Each text is one SELECT over whole tables that Spark and DuckDB both understand; names in braces
are the sample tables. Keys are integers there instead of GUIDs, so no operator may assume a key
type. CASE expressions only turn some values into NULL or zero to reach the edge cases.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from givingledger.sources.tables import DonorTables, table_schema

SAMPLE_SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "region": "r_regionkey int, r_name string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}

SAMPLE_VIEWS = {
    "donors": """
        SELECT c_custkey AS DonorProfileID, c_name AS CalculatedGivingName,
          'Dear ' || c_name AS CalculatedGreeting,
          CASE WHEN c_custkey % 5 <> 0 THEN c_custkey % 13 = 0 END AS IsDonorAdvisedFund,
          CASE WHEN c_custkey % 7 = 0 THEN c_custkey + 2 END AS OverrideAddressID,
          CASE WHEN c_custkey % 9 = 0 THEN c_custkey + 1 END AS OverridePhoneNumberID,
          CASE WHEN c_custkey % 8 = 0 THEN c_custkey + 3 END AS OverrideEmailAddressID
        FROM {customer}""",
    "donations": """
        SELECT CASE WHEN o_custkey % 10 <> 0 THEN o_custkey END AS DonorProfileID,
          CAST(CASE WHEN o_orderkey % 97 = 0 THEN NULL
            WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 0
            ELSE o_totalprice END AS DECIMAL(19,4)) AS Amount,
          o_orderdate AS DonatedOn,
          CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' OR o_orderstatus <> 'P'
            THEN o_orderpriority = '1-URGENT' END AS IsStock,
          CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' OR o_orderstatus <> 'F'
            THEN o_orderpriority = '5-LOW' END AS InKind,
          CASE WHEN o_orderpriority = '5-LOW' AND o_orderkey % 3 <> 0
            THEN CAST(CAST(o_totalprice AS DECIMAL(19,4)) + 10 AS DECIMAL(19,4))
            END AS InKindFairMarketValue,
          CASE WHEN o_orderpriority = '1-URGENT' AND o_orderkey % 4 <> 0
            THEN CAST(CAST(o_totalprice AS DECIMAL(19,4)) + 100 AS DECIMAL(19,4))
            END AS StockFairMarketValue,
          o_orderkey % 5 AS DonationCampaignID, o_orderkey % 250 AS FundID,
          CASE WHEN o_orderkey % 7 < 5 THEN o_orderkey % 120 END AS DonationAppealID
        FROM {orders}""",
    "donor_links": """
        SELECT c_custkey AS DonorProfileID,
          CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 5 = 1 THEN c_nationkey
            ELSE c_custkey - c_custkey % 2 END AS ParentID,
          CASE WHEN c_custkey % 6 <> 5 THEN c_custkey % 11 <> 0 END AS IsDefault,
          c_custkey % 4 AS ParentSystemClassID
        FROM {customer}
        UNION ALL SELECT c_custkey, c_custkey + 1, FALSE, 3 FROM {customer}""",
    "companies": """
        SELECT s_suppkey AS CompanyID,
          CASE WHEN s_suppkey % 3 = 0 THEN 'Donor Advised Fund'
            WHEN s_suppkey % 3 = 1 THEN 'Business' END AS OrganizationType
        FROM {supplier}""",
    "addresses": """
        SELECT c_custkey AS AddressID, c_name AS SalutationFirstname,
          CASE WHEN c_custkey % 4 <> 0 THEN ' Family' END AS SalutationLastname,
          'The ' || c_name AS FamilySalutation,
          CAST(c_custkey AS STRING) || ' Main St' AS Address1,
          CASE WHEN c_custkey % 2 = 0 THEN ' Apt 1' END AS Address2, n_name AS City,
          r_name AS Region,
          CASE WHEN c_custkey % 5 <> 0 THEN '9000' || CAST(c_nationkey % 10 AS STRING)
            END AS PostalCode, 'US' AS CountryCode
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
          JOIN {region} ON n_regionkey = r_regionkey""",
    "address_links": """
        SELECT c_custkey AS ParentID, c_custkey AS AddressID, c_custkey % 3 <> 0 AS IsDefault
        FROM {customer}
        UNION ALL SELECT c_custkey, c_custkey + 1, c_custkey % 5 = 0 FROM {customer}""",
    "phones": """
        SELECT c_custkey AS PhoneNumberID, '555-' || CAST(c_custkey AS STRING) AS Number
        FROM {customer}""",
    "phone_links": """
        SELECT CASE WHEN c_custkey % 10 <> 3 THEN c_custkey END AS PhoneNumberID,
          c_custkey AS ParentID, TRUE AS IsDefault
        FROM {customer}
        UNION ALL SELECT CASE WHEN c_custkey % 10 <> 3 THEN c_custkey END, c_custkey + 1, FALSE
        FROM {customer}""",
    "emails": """
        SELECT c_custkey AS EmailAddressID, c_custkey AS ParentID,
          lower(c_name) || '@a.example' AS Email
        FROM {customer}
        UNION ALL SELECT -1 - c_custkey, c_custkey + 7, lower(c_name) || '@b.example'
        FROM {customer}""",
    "campaigns": """
        SELECT r_regionkey AS DonationCampaignID, r_name AS Title,
          CAST(r_regionkey AS DOUBLE) * 300000000 AS GoalAmount
        FROM {region}""",
    "funds": "SELECT p_partkey AS FundID, p_brand AS Title FROM {part}",
    "appeals": """
        SELECT s_suppkey AS DonationAppealID,
          CASE WHEN s_suppkey % 6 <> 5 THEN s_name END AS Title
        FROM {supplier}""",
    "notes": """
        SELECT doc_id AS ParentID, doc_id % 150 AS CreatedBy, text AS NoteText,
          o_orderdate AS Created
        FROM {documents} JOIN {orders} ON doc_id = o_orderkey""",
    "users": "SELECT s_suppkey AS UserID, s_name AS UserName FROM {supplier}",
    "giving_levels": """
        SELECT CAST(floor(p_partkey / 8) AS BIGINT) AS DonationTemplateID, CAST(p_retailprice AS DECIMAL(19,4)) AS Amount,
          CASE WHEN p_partkey % 4 <> 3 THEN p_brand END AS Title, p_partkey % 3 <> 0 AS Active
        FROM {part}""",
}

# Donors of one market segment, as an id list; and the same ids wrapped in XML, next to one more.
LISTED_DONORS = "SELECT c_custkey AS ProfileID FROM {customer} WHERE c_mktsegment = 'BUILDING'"
# A list that turns out to be empty when the data are read, and donors with text for keys.
NO_DONORS = "SELECT c_custkey AS ProfileID FROM {customer} WHERE c_acctbal > 1000000"
TEXT_DONORS = """
    SELECT lower(c_name) AS DonorProfileID, c_name AS CalculatedGivingName FROM {customer}"""
LISTED_TEXT_DONORS = """
    SELECT '  ' || upper(c_name) || ' ' AS ProfileID FROM {customer}
    WHERE c_mktsegment = 'BUILDING'"""
# Amounts of up to 15 digits before the point, and bases down to a ten-thousandth, below zero and zero.
EXTREME_AMOUNTS = """
    SELECT o_orderkey AS OrderKey,
      CAST(CASE o_orderkey % 5 WHEN 0 THEN 900000000000000 WHEN 1 THEN -900000000000000 WHEN 2 THEN 90000000001
        ELSE 0 END + CAST(o_totalprice AS DECIMAL(19,4)) AS DECIMAL(29,4)) AS New,
      CAST(CASE o_orderkey % 7 WHEN 0 THEN 0.0001 WHEN 1 THEN -0.0003 WHEN 2 THEN 0 WHEN 3 THEN 123456789012345.6789
        ELSE CAST(o_totalprice AS DECIMAL(19,4)) END AS DECIMAL(29,4)) AS Base
    FROM {orders}"""
ID_DOCUMENTS = """
    SELECT CASE WHEN o_orderkey % 10 <> 0 THEN '<GuidList><Guid>' || CAST(o_custkey AS STRING)
      || '</Guid><Guid> ' || CAST(o_orderkey AS STRING) || ' </Guid></GuidList>' END AS Document
    FROM {orders}"""



# Sample keys as GUID text that sorts like them; both halves of it differ between neighbours.
GUID_TEXT = "concat(lpad(lower(hex(({0} + 1073741824) DIV 16)), 8, '0'), '-0000-4000-8000-', lpad(lower(hex(pmod({0} + 1073741824, 16))), 12, '0'))"


def sample_query(spark: SparkSession, folder: str, text: str) -> DataFrame:
    """A SELECT of this module over the sample files."""
    used = {
        name: spark.read.schema(schema).parquet(f"{folder}/{name}.parquet")
        for name, schema in SAMPLE_SCHEMAS.items()
        if f"{{{name}}}" in text
    }
    return spark.sql(text, **used)


def donor_tables(spark: SparkSession, folder: str) -> DonorTables:
    return DonorTables(lambda name: sample_query(spark, folder, SAMPLE_VIEWS[name]))


def guid_tables(spark: SparkSession, folder: str) -> DonorTables:
    """The same tables with GUID text for ids."""
    plain = donor_tables(spark, folder)

    def load(name: str) -> DataFrame:
        ids = [c for c in table_schema(name).names if (c.endswith("ID") or c == "CreatedBy") and c != "ParentSystemClassID"]
        return getattr(plain, name).withColumns({c: F.expr(f"CASE WHEN {c} IS NOT NULL THEN {GUID_TEXT.format(c)} END") for c in ids})

    return DonorTables(load, guids=True)
