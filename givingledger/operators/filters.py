"""Restricting an export to listed donors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from givingledger.sources.donor_ids import plain_id

DONOR = "DonorProfileID"


def keep_listed(rows: DataFrame, donor_ids: DataFrame | None) -> DataFrame:
    """Rows of the listed donors; all rows if there is no list or it has no rows.

    Listed ids that are text match without regard to case and blanks around them. A NULL or empty
    id in the list matches nobody, and a list of such ids only keeps nobody.

    The rows are those of a semi-join, for which Spark can filter a large scan by the list at run
    time, and those of a second branch for the empty list. Whether the list is empty is known from
    one row before that branch begins, and if it is not, adaptive execution drops the branch.
    """
    if donor_ids is None:
        return rows
    listed = F.col("ProfileID")
    if isinstance(donor_ids.schema["ProfileID"].dataType, StringType):
        listed = plain_id(listed)
    ids = donor_ids.select(listed.alias(DONOR)).filter(F.length(F.col(DONOR).cast("string")) > 0)
    empty = donor_ids.limit(1).agg(F.count(F.lit(1)).alias("ListSize")).filter("ListSize = 0")
    everything = rows.crossJoin(F.broadcast(empty)).select(*rows.columns)  # a single row, or none
    return rows.join(ids, DONOR, "left_semi").select(*rows.columns).unionByName(everything)
