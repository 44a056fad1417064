"""Address, phone, e-mail and fund flag of each donor.

A donor may override each contact; otherwise it comes from the donor's default parent (a person,
household or company). Where several candidates exist the smallest id is taken.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from givingledger.functions.ids import (
    LONG_ZERO,
    guid_halves,
    guid_of,
    is_number,
    place_of,
    smallest_guids,
    tag_of,
    tagged,
)
from givingledger.functions.text import blank_if_null, comparable
from givingledger.operators.joins import lookup, union_of
from givingledger.params import ExportParams
from givingledger.sources.tables import DonorTables

DONOR = "DonorProfileID"

CONTACT_COLUMNS = (
    "ActualGivingName",
    "ActualGreeting",
    "ActualAddressSalutation",
    "FamilySalutation",
    "RecipientAddress",
    "Address1",
    "Address2",
    "City",
    "Region",
    "PostalCode",
    "CountryCode",
    "ActualEmailAddressTitle",
    "ActualPhoneNumberTitle",
)


# Kinds of contact that a parent has, and where the smallest id of each is told.
PARENT_IDS = {"address": "ParentAddressID", "phone": "ParentPhoneNumberID", "email": "ParentEmailAddressID"}


def default_parent(donor_links: DataFrame, guids: bool = False) -> DataFrame:
    """One row per donor with a default link: its parent, the parent's class, and how many.

    Of several links the one with the smallest known parent counts, then that with the smallest
    class. Parents that are numbers, or GUID text (``guids``), are compared as numbers, which stay
    in hash aggregates; links are combined before they are shuffled, also those of one donor.
    """
    links = donor_links.filter("IsDefault")
    if is_number(links.schema["ParentID"].dataType):
        place = f"CAST(ParentID AS DECIMAL(20,0)) + {LONG_ZERO}BD"
        return (
            links.groupBy(DONOR)
            .agg(
                F.expr(f"min({tagged(place, 'ParentSystemClassID')}) AS Choice"),
                F.count(F.lit(1)).alias("DefaultLinks"),
            )
            .select(
                DONOR,
                F.expr(f"CAST({place_of('Choice')} - {LONG_ZERO}BD AS BIGINT)")
                .cast(links.schema["ParentID"].dataType)
                .alias("ParentID"),
                F.expr(tag_of("Choice")).alias("ParentSystemClassID"),
                "DefaultLinks",
            )
        )
    if guids:
        high, low = guid_halves(F.col("ParentID"))
        halves = links.select(DONOR, high.alias("High"), low.alias("Low"), "ParentSystemClassID")
        by_high = halves.groupBy(DONOR, "High").agg(
            F.expr(f"min({tagged('Low', 'ParentSystemClassID')}) AS Choice"),
            F.count(F.lit(1)).alias("Links"),
        )
        least = by_high.groupBy(DONOR).agg(
            F.min("High").alias("High"),
            F.expr("coalesce(min_by(Choice, High), min(Choice)) AS Choice"),
            F.sum("Links").alias("DefaultLinks"),
        )
        return least.select(
            DONOR,
            guid_of(F.col("High"), F.expr(place_of("Choice"))).alias("ParentID"),
            F.expr(tag_of("Choice")).alias("ParentSystemClassID"),
            "DefaultLinks",
        )
    choice = F.struct(F.col("ParentID").isNull(), "ParentID", "ParentSystemClassID")
    return (
        links.groupBy(DONOR)
        .agg(F.min(choice).alias("Choice"), F.count(F.lit(1)).alias("DefaultLinks"))
        .select(DONOR, "Choice.ParentID", "Choice.ParentSystemClassID", "DefaultLinks")
    )


def parent_contacts(tables: DonorTables) -> DataFrame:
    """One row per parent with the smallest address, phone and e-mail id that donors look up there."""
    kinds = {
        "address": tables.address_links.filter("IsDefault").select("ParentID", F.col("AddressID").alias("ID")),
        "phone": tables.phone_links.filter("IsDefault").select("ParentID", F.col("PhoneNumberID").alias("ID")),
        "email": tables.emails.select("ParentID", F.col("EmailAddressID").alias("ID")),
    }
    stacked = reduce(
        DataFrame.unionByName,
        [
            rows.filter(F.col("ParentID").isNotNull()).select("ParentID", F.lit(kind).alias("Kind"), "ID")
            for kind, rows in kinds.items()
        ],
    )
    if tables.guids:
        return smallest_guids(stacked, "ParentID", PARENT_IDS)
    return stacked.groupBy("ParentID").agg(
        *[F.expr(f"min(ID) FILTER (WHERE Kind = '{kind}') AS {name}") for kind, name in PARENT_IDS.items()]
    )


def resolved_contacts(donors: DataFrame, tables: DonorTables) -> DataFrame:
    """Donors with the ids of their contacts. Only ids move through the joins."""
    parents = union_of([default_parent(part, tables.guids) for part in tables.parts("donor_links")])
    with_parent = donors.join(parents, DONOR, "left")
    return (
        lookup(with_parent, parent_contacts(tables), "ParentID", DONOR)
        .withColumns(
            {
                "AddressID": F.coalesce("OverrideAddressID", "ParentAddressID"),
                "PhoneNumberID": F.coalesce("OverridePhoneNumberID", "ParentPhoneNumberID"),
                "EmailAddressID": F.coalesce("OverrideEmailAddressID", "ParentEmailAddressID"),
            }
        )
    )


def with_fund_organization(resolved: DataFrame, tables: DonorTables, params: ExportParams) -> DataFrame:
    """Whether the parent is an organization of the wanted type; NULL if it is none or has no type.

    Of several rows of one company, one of the wanted type is enough.
    """
    wanted = F.lit(params.daf_organization_type).cast("string")
    matches = comparable(F.col("OrganizationType"), params.ignore_case) == comparable(wanted, params.ignore_case)
    companies = tables.companies.filter(F.col("CompanyID").isNotNull())
    flags = companies.groupBy(F.col("CompanyID").alias("ParentID")).agg(F.max(matches).alias("IsFundOrganization"))
    return lookup(resolved, flags, "ParentID", DONOR)


def with_address(resolved: DataFrame, tables: DonorTables) -> DataFrame:
    return lookup(resolved, tables.addresses, "AddressID", DONOR)


def with_phone(resolved: DataFrame, tables: DonorTables) -> DataFrame:
    """A number is found only if some link mentions it, even where a donor overrides the phone."""
    linked = tables.phones.join(tables.phone_links, "PhoneNumberID", "left_semi")
    return lookup(resolved, linked, "PhoneNumberID", DONOR)


def with_email(resolved: DataFrame, tables: DonorTables) -> DataFrame:
    emails = tables.emails.select("EmailAddressID", "Email")
    return lookup(resolved, emails, "EmailAddressID", DONOR)


def donor_advised_fund(params: ExportParams, strict: bool = True) -> Column:
    """Own flag, or default parent's organization type, or its class. Unknown counts as no."""
    organization = F.col("IsFundOrganization")
    parent_class = F.col("ParentSystemClassID") == F.lit(params.daf_class_id).cast("int")
    flag = F.coalesce(F.col("IsDonorAdvisedFund") | organization | parent_class, F.lit(False))
    if not strict:
        return flag
    several = F.raise_error(
        F.concat(F.lit("several default links: donor "), F.col(DONOR).cast("string"))
    )
    return F.when(F.col("DefaultLinks") > 1, several.cast("boolean")).otherwise(flag)


def recipient_address() -> Column:
    street = F.concat(blank_if_null(F.col("Address1")), blank_if_null(F.col("Address2")))
    rest = [blank_if_null(F.col(name)) for name in ("City", "Region", "PostalCode")]
    return F.concat_ws(" ", street, *rest)


def contact_block(
    donors: DataFrame, tables: DonorTables, params: ExportParams, strict: bool = True
) -> DataFrame:
    """Donor, contact columns and fund flag, without duplicates.

    Rows are spread by donor first: the duplicate check and the later joins by donor both use
    that layout, so the check adds no shuffle of its own.
    """
    resolved = with_fund_organization(resolved_contacts(donors, tables), tables, params)
    flagged = resolved.withColumn("IsDonorAdvisedFund", donor_advised_fund(params, strict))
    # The wide address columns come last, so that they are not shuffled again for another lookup.
    found = with_address(with_email(with_phone(flagged, tables), tables), tables)
    return (
        found.withColumns(
            {
                "ActualGivingName": F.col("CalculatedGivingName"),
                "ActualGreeting": F.col("CalculatedGreeting"),
                "ActualAddressSalutation": F.concat("SalutationFirstname", "SalutationLastname"),
                "RecipientAddress": recipient_address(),
                "ActualEmailAddressTitle": F.col("Email"),
                "ActualPhoneNumberTitle": F.col("Number"),
            }
        )
        .select(DONOR, *CONTACT_COLUMNS, "IsDonorAdvisedFund")
        .repartition(DONOR)
        .distinct()
    )
