"""One query per operator over the sample tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from givingledger.functions.money import percent_change
from givingledger.names import (
    ALL_DONOR_AVERAGE,
    EMPTY_TEXT_COLUMNS,
    TOP_DONOR_AVERAGE,
    ZERO_COLUMNS,
)
from givingledger.operators import contacts, giving, labels, peers
from givingledger.operators.campaign import campaign_columns, campaign_summary
from givingledger.operators.donations import (
    donations_in_window,
    valued_donations,
    window_activity,
    year_to_date_total,
)
from givingledger.operators.filters import keep_listed
from givingledger.operators.notes import note_column, with_notes
from givingledger.params import ExportParams
from givingledger.plans.export import (
    current_date_column,
    donor_export,
    named,
    parameter_columns,
    placeholder_columns,
)
from givingledger.sources.donor_ids import donor_ids_from_documents
from givingledger.sources.layout import lay_out_tables
from givingledger.sources.sample_views import (
    EXTREME_AMOUNTS,
    ID_DOCUMENTS,
    LISTED_DONORS,
    LISTED_TEXT_DONORS,
    NO_DONORS,
    TEXT_DONORS,
    donor_tables,
    guid_tables,
    sample_query,
)
from givingledger.sources.scratch import new_folder
from givingledger.sources.tables import SCHEMAS, DonorTables, table_schema

DONOR = "DonorProfileID"
Query = Callable[[SparkSession, str], DataFrame]

# Order dates run from 1995-01-01 to 2001-08-01. The start lies ahead of the clock and so moves
# back to 2001-07-01: gifts fall in the windows 0 to 7, and 8 and 9 stay empty.
SAMPLE_PARAMS = ExportParams(
    fiscal_start=datetime(2002, 7, 1),
    as_of=datetime(2001, 12, 1),
    school_name="Hillside School",
    school_address="1 Hill Road",
    school_phone="555-0100",
    school_email="giving@hillside.example",
    campaign_id=1,
    top_percent=10,
    base_url="https://hillside.example",
    giving_template_id=7,
    daf_class_id=3,
    daf_organization_type="Donor Advised Fund",
)


# Three years later all ten windows hold gifts.
LATER = {"fiscal_start": datetime(2005, 7, 1), "as_of": datetime(2004, 12, 1)}


def _query(build: Callable[[DonorTables, ExportParams], DataFrame], **changes: object) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(donor_tables(spark, folder), replace(SAMPLE_PARAMS, **changes))

    return run


def _pick(rows: DataFrame, columns: dict[str, Column | str]) -> DataFrame:
    return rows.select(DONOR, *named(columns))


def _giving(columns: Callable[[ExportParams], dict[str, str]], **changes: object) -> Query:
    """A query on columns that derive from a donor's gifts; unused aggregates are pruned."""

    def build(tables: DonorTables, params: ExportParams) -> DataFrame:
        donors = tables.donors.select(DONOR)
        return _pick(giving.with_giving(donors, tables.donations, params), columns(params))

    return _query(build, **changes)


def _scan_donor_base(tables: DonorTables, params: ExportParams) -> DataFrame:
    columns = {**parameter_columns(params), **current_date_column(params)}
    return tables.donors.select("*", *named(columns))


def _donor_filter(listed: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ids = sample_query(spark, folder, listed)
        donors = donor_tables(spark, folder).donors
        return keep_listed(donors, ids).select(DONOR, "CalculatedGivingName")

    return run


def _text_key_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Donors told apart by text, and a list in upper case with blanks around."""
    donors = sample_query(spark, folder, TEXT_DONORS)
    return keep_listed(donors, sample_query(spark, folder, LISTED_TEXT_DONORS))


def _table_counts(tables: DonorTables, params: ExportParams) -> DataFrame:
    """Rows and known first ids of each base table."""
    counts = [
        getattr(tables, name).agg(
            F.lit(name).alias("TableName"),
            F.count(F.lit(1)).alias("Rows"),
            F.count(table_schema(name).names[0]).alias("KnownIDs"),
        )
        for name in SCHEMAS
    ]
    return reduce(DataFrame.unionByName, counts)


def _id_list(spark: SparkSession, folder: str) -> DataFrame:
    documents = sample_query(spark, folder, ID_DOCUMENTS)
    return donor_ids_from_documents(documents, "Document", id_type="bigint")


def _listed_export(spark: SparkSession, folder: str) -> DataFrame:
    ids = sample_query(spark, folder, LISTED_DONORS)
    return donor_export(donor_tables(spark, folder), SAMPLE_PARAMS, ids)


def _labels(purpose: str) -> Query:
    def build(tables: DonorTables, params: ExportParams) -> DataFrame:
        chosen = {purpose: labels.gift_purposes(tables)[purpose]}
        texts = labels.gift_labels(tables.donations, chosen)
        return tables.donors.select(DONOR).join(texts, DONOR, "left")

    return _query(build)


def _single_row_per_donor(
    tables: DonorTables, single_row: DataFrame, columns: dict[str, Column | str]
) -> DataFrame:
    return _pick(tables.donors.select(DONOR).crossJoin(F.broadcast(single_row)), columns)


def _campaign_columns(tables: DonorTables, params: ExportParams) -> DataFrame:
    row = campaign_summary(tables.campaigns, tables.donations, params)
    return _single_row_per_donor(tables, row, campaign_columns(params))


def _year_to_date(tables: DonorTables, params: ExportParams) -> DataFrame:
    names = ("DonatedYearToDate", "DonatedYearToDateFormatted")
    row = year_to_date_total(tables.donations, params)
    return _single_row_per_donor(tables, row, {name: f"`{name}`" for name in names})


def _school_averages(tables: DonorTables, params: ExportParams) -> DataFrame:
    row = peers.peer_averages(tables.donations, params)
    names = (ALL_DONOR_AVERAGE, TOP_DONOR_AVERAGE)
    return _single_row_per_donor(tables, row, {name: f"`{name}`" for name in names})


def _school_top_average(tables: DonorTables, params: ExportParams) -> DataFrame:
    return peers.peer_averages(tables.donations, params).select(
        "Gifts", "Take", "Donated", "TopDonated", TOP_DONOR_AVERAGE
    )


def _sentence(tables: DonorTables, params: ExportParams) -> DataFrame:
    averages = peers.peer_averages(tables.donations, params)
    return averages.select(peers.top_average_sentence(params).alias("TopAverageSentence"))


def _fund_flag(tables: DonorTables, params: ExportParams) -> DataFrame:
    flag = contacts.donor_advised_fund(params)
    resolved = contacts.resolved_contacts(tables.donors, tables)
    flagged = contacts.with_fund_organization(resolved, tables, params)
    return _pick(flagged, {"IsDonorAdvisedFund": flag})


def _resolution(
    join: Callable[[DataFrame, DonorTables], DataFrame], *names: str
) -> Query:
    def build(tables: DonorTables, params: ExportParams) -> DataFrame:
        resolved = contacts.resolved_contacts(tables.donors, tables)
        return join(resolved, tables).select(DONOR, *names)

    return _query(build)


def _notes(tables: DonorTables, params: ExportParams) -> DataFrame:
    noted = with_notes(tables.donors.select(DONOR), tables.notes, tables.users)
    return _pick(noted, {"Notes": note_column()})


def _guid_query(build: Callable[[DonorTables], DataFrame]) -> Query:
    return lambda spark, folder: build(guid_tables(spark, folder))


def _laid_out_export(spark: SparkSession, folder: str) -> DataFrame:
    """The export over tables laid out by donor, written first."""
    root = new_folder(spark, "layout")
    prefix = root.rsplit("/", 1)[1].replace("-", "_") + "_"
    return donor_export(lay_out_tables(donor_tables(spark, folder), spark, root, prefix), SAMPLE_PARAMS)


def _extreme_percent_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Percent changes between amounts of all sizes, up to 15 digits against a ten-thousandth."""
    return sample_query(spark, folder, EXTREME_AMOUNTS).select(
        "OrderKey", F.expr(percent_change("New", "Base")).cast("decimal(34,2)").alias("PercentChange"))


def catalog() -> dict[str, Query]:
    return {
        "scan_donor_base": _query(_scan_donor_base),
        "donor_id_list_xml": _id_list,
        "scan_table_counts": _query(_table_counts),
        "donor_filter_by_ids": _donor_filter(LISTED_DONORS),
        "donor_filter_by_ids_nonempty": _donor_filter(LISTED_DONORS),
        "donor_filter_empty_list": _donor_filter(NO_DONORS),
        "donor_filter_text_keys": _text_key_filter,
        "valued_donations": _query(
            lambda t, p: valued_donations(t.donations).select(
                DONOR, "DonatedOn", "Amount", "IsStock", "InKind", "ValuedAmount"
            )
        ),
        "donations_in_window": _query(
            lambda t, p: donations_in_window(t.donations, p.calendar.windows[2]).select(
                DONOR, "DonatedOn", "Amount"
            )
        ),
        "fiscal_windows": _query(lambda t, p: window_activity(t.donations, p.calendar)),
        "lifetime_totals": _giving(lambda p: giving.lifetime_columns()),
        "donor_status": _giving(giving.status_columns),
        "total_years_given": _giving(lambda p: giving.years_given_columns()),
        "gift_counts_lifetime": _giving(lambda p: giving.lifetime_count_columns()),
        "gift_counts_ytd": _giving(lambda p: giving.this_year_count_columns()),
        "gift_counts_last_fy": _giving(lambda p: giving.last_year_count_columns()),
        "first_gift": _giving(lambda p: giving.first_gift_columns()),
        "last_gift": _giving(lambda p: giving.last_gift_columns()),
        "largest_gift": _giving(lambda p: giving.largest_gift_columns()),
        "fy_window_totals": _giving(lambda p: giving.window_total_columns()),
        "fy_window_formatted": _giving(lambda p: giving.window_formatted_columns()),
        "fy_window_valued": _giving(lambda p: giving.window_valued_columns()),
        "donated_last_year": _giving(lambda p: giving.last_year_columns()),
        "donated_previous_three_years": _giving(lambda p: giving.previous_three_years_columns()),
        "percent_changes": _giving(lambda p: giving.percent_change_columns()),
        "donor_rollup": _giving(
            lambda p: {**giving.giving_columns(p), **giving.window_label_columns(p)}
        ),
        "ytd_total_all_donors": _query(_year_to_date),
        "default_parent": _query(
            lambda t, p: contacts.default_parent(t.donor_links).select(
                DONOR, "ParentID", "ParentSystemClassID"
            )
        ),
        "address_resolution": _resolution(
            contacts.with_address, "AddressID", "Address1", "City", "PostalCode"
        ),
        "phone_resolution": _resolution(contacts.with_phone, "PhoneNumberID", "Number"),
        "email_resolution": _resolution(contacts.with_email, "EmailAddressID", "Email"),
        "is_donor_advised_fund": _query(_fund_flag),
        "contact_block": _query(
            lambda t, p: contacts.contact_block(t.donors, t, p).drop("IsDonorAdvisedFund")
        ),
        "campaign_summary": _query(
            lambda t, p: campaign_summary(t.campaigns, t.donations, p)
        ),
        "campaign_columns": _query(_campaign_columns),
        "campaign_columns_unknown": _query(_campaign_columns, campaign_id=99),
        "school_prev_fy_amounts": _query(
            lambda t, p: peers.previous_year_amounts(t.donations, p)
        ),
        "school_prev_fy_amounts_campaign": _query(
            lambda t, p: peers.previous_year_amounts(t.donations, p), average_campaign_id=3
        ),
        "school_averages": _query(_school_averages),
        "school_averages_empty": _query(_school_averages, fiscal_start=datetime(1990, 7, 1)),
        "school_top_average": _query(_school_top_average, top_percent=25),
        "top_average_sentence": _query(_sentence, include_top_average_sentence=True),
        "donor_campaigns": _labels("Campaigns"),
        "donor_funds": _labels("Funds"),
        "donor_appeals": _labels("Appeals"),
        "donor_notes": _query(_notes),
        "giving_levels": _query(
            lambda t, p: labels.giving_levels(t.giving_levels, p), giving_template_id=None
        ),
        "giving_levels_of_form": _query(lambda t, p: labels.giving_levels(t.giving_levels, p)),
        "export_placeholders": _query(
            lambda t, p: _pick(t.donors, placeholder_columns()).select(
                DONOR, *EMPTY_TEXT_COLUMNS, *ZERO_COLUMNS
            )
        ),
        "donor_export": _query(donor_export),
        "donor_export_listed": _listed_export,
        "donor_export_laid_out": _laid_out_export,
        "default_parent_guid": _guid_query(
            lambda t: contacts.default_parent(t.donor_links, t.guids).select(DONOR, "ParentID", "ParentSystemClassID")
        ),
        "parent_contacts_guid": _guid_query(contacts.parent_contacts),
        "percent_changes_extreme": _extreme_percent_changes,
        "percent_changes_later": _giving(lambda p: giving.percent_change_columns(), **LATER),
        "donor_rollup_later": _giving(
            lambda p: {**giving.giving_columns(p), **giving.window_label_columns(p)}, **LATER
        ),
        "fiscal_windows_later": _query(lambda t, p: window_activity(t.donations, p.calendar), **LATER),
    }
