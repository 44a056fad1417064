"""The donor export: one wide row per donor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from givingledger.names import (
    ALL_DONOR_AVERAGE,
    EMPTY_TEXT_COLUMNS,
    EXPORT_COLUMNS,
    TOP_DONOR_AVERAGE,
    ZERO_COLUMNS,
)
from givingledger.operators.campaign import campaign_columns, campaign_summary
from givingledger.operators.contacts import CONTACT_COLUMNS, DONOR, contact_block
from givingledger.operators.donations import year_to_date_total
from givingledger.operators.filters import keep_listed
from givingledger.operators.giving import (
    donor_rollup,
    giving_columns,
    giving_history,
    join_giving,
    window_label_columns,
)
from givingledger.operators.joins import union_of
from givingledger.operators.labels import gift_labels, gift_purposes
from givingledger.operators.notes import note_column, with_notes
from givingledger.operators.peers import peer_averages
from givingledger.params import ExportParams
from givingledger.sources.tables import DonorTables


def named(columns: dict[str, Column | str]) -> list[Column]:
    """Columns, or SQL texts, under their names."""
    return [
        F.expr(f"{column} AS `{name}`") if isinstance(column, str) else column.alias(name)
        for name, column in columns.items()
    ]


def parameter_columns(params: ExportParams) -> dict[str, Column]:
    values = {
        "SchoolName": params.school_name,
        "SchoolAddress": params.school_address,
        "SchoolPhone": params.school_phone,
        "SchoolEmailAddress": params.school_email,
    }
    return {name: F.lit(value).cast("string") for name, value in values.items()}


def placeholder_columns() -> dict[str, str]:
    return {
        **{name: "''" for name in EMPTY_TEXT_COLUMNS},
        **{name: "0" for name in ZERO_COLUMNS},
    }


def current_date_column(params: ExportParams) -> dict[str, Column]:
    return {"CurrentDate": F.lit(params.as_of.strftime("%m/%d/%Y"))}


def donor_export(
    tables: DonorTables,
    params: ExportParams,
    donor_ids: DataFrame | None = None,
    strict: bool = True,
) -> DataFrame:
    """All columns of ``EXPORT_COLUMNS`` for all donors, or for those in ``donor_ids``.

    An empty id list means all donors. With a list, the gifts of other donors are dropped before
    the rollup. ``strict`` stops on donors with several notes or several default
    links; otherwise the first one counts.
    """
    donors = keep_listed(tables.donors, donor_ids)
    own_gifts = [keep_listed(part, donor_ids) for part in tables.parts("donations")]
    purposes = gift_purposes(tables)
    rollup = union_of([donor_rollup(giving_history(part, params)) for part in own_gifts])
    labels = union_of([gift_labels(part, purposes, params.ignore_case) for part in own_gifts])

    # These four share the layout by donor; the frames after them are single rows.
    contacts = contact_block(donors, tables, params, strict)
    rows = join_giving(contacts, rollup).join(labels, DONOR, "left")
    rows = with_notes(rows, tables.parts("notes"), tables.users)
    averages = peer_averages(tables.donations, params).select(ALL_DONOR_AVERAGE, TOP_DONOR_AVERAGE)
    for single_row in (
        campaign_summary(tables.campaigns, tables.donations, params),
        year_to_date_total(tables.donations, params),
        averages,
    ):
        rows = rows.crossJoin(F.broadcast(single_row))

    unchanged = (
        DONOR,
        *CONTACT_COLUMNS,
        "IsDonorAdvisedFund",
        "DonatedYearToDate",
        "DonatedYearToDateFormatted",
        ALL_DONOR_AVERAGE,
        TOP_DONOR_AVERAGE,
        "Campaigns",
        "Funds",
        "Appeals",
    )
    columns: dict[str, Column | str] = {
        **{name: f"`{name}`" for name in unchanged},
        **parameter_columns(params),
        **placeholder_columns(),
        **giving_columns(params),
        **window_label_columns(params),
        **campaign_columns(params),
        **current_date_column(params),
        "Notes": note_column(strict),
    }
    return rows.select(*named({name: columns[name] for name in EXPORT_COLUMNS}))
