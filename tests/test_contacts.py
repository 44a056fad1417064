"""Contacts, fund flag, notes and the donor filter on hand-made donors."""

from __future__ import annotations

from datetime import datetime

import pytest
from fixtures import donor, export_row, make_tables, params
from pyspark.errors import PySparkException

from givingledger.operators.contacts import contact_block
from givingledger.operators.filters import keep_listed
from givingledger.operators.notes import note_column, with_notes

LINK = {"DonorProfileID": "d", "ParentID": "p", "IsDefault": True, "ParentSystemClassID": 4}


def contact_rows(spark, run=None, strict=True, **rows):
    tables = make_tables(spark, **({"donors": [donor()]} | rows))
    block = contact_block(tables.donors, tables, run or params(), strict)
    return [row.asDict() for row in block.collect()]


def contact_row(spark, run=None, **rows):
    (row,) = contact_rows(spark, run, **rows)
    return row


def noted(spark, strict=True, **rows):
    tables = make_tables(spark, donors=[donor()], **rows)
    joined = with_notes(tables.donors, tables.notes, tables.users)
    (row,) = joined.select(note_column(strict)).collect()
    return row[0]


def test_no_address(spark):
    row = contact_row(spark)
    assert row["RecipientAddress"] == "   "
    assert row["ActualAddressSalutation"] is None


def test_default_address(spark):
    row = contact_row(
        spark,
        donor_links=[LINK, LINK | {"ParentID": "a", "IsDefault": False}],
        address_links=[
            {"ParentID": "p", "AddressID": "a2", "IsDefault": True},
            {"ParentID": "p", "AddressID": "a1", "IsDefault": False},
        ],
        addresses=[
            {"AddressID": "a1", "Address1": "no"},
            {
                "AddressID": "a2",
                "Address1": "1 Main",
                "Address2": "Apt 2",
                "City": "Town",
                "Region": "CA",
                "PostalCode": "90000",
                "SalutationFirstname": "Ann",
                "SalutationLastname": "Lee",
            },
        ],
    )
    assert row["RecipientAddress"] == "1 MainApt 2 Town CA 90000"
    assert row["ActualAddressSalutation"] == "AnnLee"


def test_override_wins(spark):
    row = contact_row(
        spark,
        donors=[donor(OverrideAddressID="a9", OverrideEmailAddressID="e9")],
        donor_links=[LINK],
        address_links=[{"ParentID": "p", "AddressID": "a1", "IsDefault": True}],
        addresses=[{"AddressID": "a1", "City": "no"}, {"AddressID": "a9", "City": "yes"}],
        emails=[
            {"EmailAddressID": "e1", "ParentID": "p", "Email": "no"},
            {"EmailAddressID": "e9", "ParentID": "q", "Email": "yes"},
        ],
    )
    assert (row["City"], row["ActualEmailAddressTitle"]) == ("yes", "yes")


def test_phone_must_be_linked(spark):
    phones = [{"PhoneNumberID": "t1", "Number": "1"}, {"PhoneNumberID": "t2", "Number": "2"}]
    links = [{"PhoneNumberID": "t1", "ParentID": "x", "IsDefault": False}]
    donors = [donor(OverridePhoneNumberID="t1"), donor("e", OverridePhoneNumberID="t2")]
    rows = contact_rows(spark, donors=donors, phones=phones, phone_links=links)
    numbers = {row["DonorProfileID"]: row["ActualPhoneNumberTitle"] for row in rows}
    assert numbers == {"d": "1", "e": None}


def test_phone_with_several_links_keeps_one_row(spark):
    row = contact_row(
        spark,
        donor_links=[LINK],
        phones=[{"PhoneNumberID": "t", "Number": "1"}],
        phone_links=[
            {"PhoneNumberID": "t", "ParentID": "p", "IsDefault": True},
            {"PhoneNumberID": "t", "ParentID": "q", "IsDefault": True},
        ],
    )
    assert row["ActualPhoneNumberTitle"] == "1"


def test_default_email_ignores_defaults(spark):
    emails = [
        {"EmailAddressID": "e2", "ParentID": "p", "Email": "second"},
        {"EmailAddressID": "e1", "ParentID": "p", "Email": "first"},
    ]
    row = contact_row(spark, donor_links=[LINK], emails=emails)
    assert row["ActualEmailAddressTitle"] == "first"


def test_equal_addresses_give_one_row_and_different_ones_two(spark):
    donors = [donor(OverrideAddressID="a")]
    same = [{"AddressID": "a", "City": "Town"}] * 2
    assert len(contact_rows(spark, donors=donors, addresses=same)) == 1
    other = [{"AddressID": "a", "City": "Town"}, {"AddressID": "a", "City": "Village"}]
    assert len(contact_rows(spark, donors=donors, addresses=other)) == 2


@pytest.mark.parametrize(
    ("flag", "links", "run", "expected"),
    [
        (True, [], {}, True),
        (False, [], {}, False),
        (None, [], {}, False),
        (None, [LINK], {"daf_class_id": 4}, True),
        (None, [LINK], {"daf_class_id": 5}, False),
        (None, [LINK | {"IsDefault": False}], {"daf_class_id": 4}, False),
        (None, [LINK | {"ParentSystemClassID": None}], {}, False),
        (None, [LINK], {"daf_organization_type": "Fund"}, True),
        (None, [LINK], {"daf_organization_type": "fund"}, False),
        (None, [LINK], {"daf_organization_type": "fund ", "ignore_case": True}, True),
        (None, [LINK | {"ParentID": "other"}], {"daf_organization_type": "Fund"}, False),
    ],
)
def test_fund_flag(spark, flag, links, run, expected):
    row = contact_row(
        spark,
        params(**run),
        donors=[donor(IsDonorAdvisedFund=flag)],
        donor_links=links,
        companies=[{"CompanyID": "p", "OrganizationType": "Fund"}],
    )
    assert row["IsDonorAdvisedFund"] is expected


def test_several_default_links(spark):
    links = [LINK, LINK | {"ParentID": "q"}]
    with pytest.raises(PySparkException, match="several default links"):
        contact_row(spark, donor_links=links)
    emails = [{"EmailAddressID": "e", "ParentID": "p", "Email": "of p"}]
    row = contact_row(spark, donor_links=links, emails=emails, strict=False)
    assert row["ActualEmailAddressTitle"] == "of p"


def note(text="Called", user="u", parent="d"):
    created = datetime(2023, 5, 2, 23, 30)
    return {"ParentID": parent, "CreatedBy": user, "NoteText": text, "Created": created}


def test_note(spark):
    users = [{"UserID": "u", "UserName": "kim"}]
    text = noted(spark, notes=[note()], users=users)
    assert text == "Called (kim, 2023-05-02)"
    assert noted(spark, notes=[note(user="x")], users=users) is None
    assert noted(spark, notes=[note(user=None)], users=users) is None


def test_several_notes(spark):
    users = [{"UserID": "u", "UserName": "kim"}]
    with pytest.raises(PySparkException, match="several notes"):
        noted(spark, notes=[note("b"), note("a")], users=users)
    text = noted(spark, notes=[note("b"), note("a")], users=users, strict=False)
    assert text == "a (kim, 2023-05-02)"
    # In the export, several notes on something that is not an exported donor do no harm.
    elsewhere = [note(parent="x"), note(parent="x")]
    assert export_row(spark, [], notes=elsewhere, users=users)["Notes"] is None


@pytest.mark.parametrize(
    ("ids", "expected"),
    [
        ([], {"a", "b", "c"}),
        (["b"], {"b"}),
        ([None], set()),
        (["c", "c", "x"], {"c"}),
        ([" A ", "C"], {"a", "c"}),
    ],
)
def test_donor_filter(spark, ids, expected):
    donors = make_tables(spark, donors=[donor("a"), donor("b"), donor("c")]).donors
    listed = spark.createDataFrame([(i,) for i in ids], "ProfileID string")
    kept = keep_listed(donors, listed)
    assert sorted(row.DonorProfileID for row in kept.collect()) == sorted(expected)
    assert kept.columns == donors.columns


def test_no_list_keeps_all(spark):
    donors = make_tables(spark, donors=[donor("a")]).donors
    assert keep_listed(donors, None) is donors
