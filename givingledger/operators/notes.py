"""The note on each donor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from givingledger.operators.joins import lookup, union_of


def note_text() -> Column:
    """The note with author and day; NULL if its text, author or date is unknown."""
    day = F.date_format("Created", "yyyy-MM-dd")
    return F.concat(F.col("NoteText"), F.lit(" ("), F.col("UserName"), F.lit(", "), day, F.lit(")"))


def note_counts(notes: DataFrame) -> DataFrame:
    """(ParentID, NoteCount), from ids alone."""
    known = notes.filter(F.col("ParentID").isNotNull())
    return known.groupBy("ParentID").agg(F.count(F.lit(1)).alias("NoteCount"))


def single_notes(notes: DataFrame, users: DataFrame) -> DataFrame:
    """(ParentID, Note) of parents with one note.

    Authors are looked up for ids; the texts move once, to their parents.
    """
    authors = users.select(F.col("UserID").alias("CreatedBy"), "UserName")
    ids = notes.filter(F.col("ParentID").isNotNull()).select("ParentID", "CreatedBy")
    one = note_counts(notes).filter("NoteCount = 1").select("ParentID")
    named = lookup(ids.join(one, "ParentID", "left_semi"), authors, "CreatedBy", "ParentID").drop("CreatedBy")
    return notes.select("ParentID", "NoteText", "Created").join(named, "ParentID").select("ParentID", note_text().alias("Note"))


def first_of_several(notes: DataFrame, users: DataFrame) -> DataFrame:
    """(ParentID, FirstNote) of parents with several notes: the first in text order."""
    several = note_counts(notes).filter("NoteCount > 1").select("ParentID")
    authors = users.select(F.col("UserID").alias("CreatedBy"), "UserName")
    rows = notes.join(several, "ParentID", "left_semi")
    named = lookup(rows, authors, "CreatedBy", "ParentID", "Created")
    return named.groupBy("ParentID").agg(F.min(note_text()).alias("FirstNote"))


def with_notes(
    donors: DataFrame,
    notes: DataFrame | list[DataFrame],
    users: DataFrame,
    key: str = "DonorProfileID",
) -> DataFrame:
    """Donors with ``Note`` and ``NoteCount``, both NULL for donors without notes.

    ``notes`` may come in parts that share no parent. Notes are counted by id. Only where a donor has several are texts compared; usually no donor
    has, and adaptive execution drops that branch once the counts are known.
    """
    parts = notes if isinstance(notes, list) else [notes]
    found = donors
    for step in (note_counts, lambda n: single_notes(n, users), lambda n: first_of_several(n, users)):
        by_parent = union_of([step(part) for part in parts])
        found = found.join(by_parent.withColumnRenamed("ParentID", key), key, "left")
    return found.withColumn("Note", F.coalesce("Note", "FirstNote")).drop("FirstNote")


def note_column(strict: bool = True, key: str = "DonorProfileID") -> Column:
    """A donor has at most one note; in strict mode a second one stops the export."""
    if not strict:
        return F.col("Note")
    several = F.raise_error(F.concat(F.lit("several notes: donor "), F.col(key).cast("string")))
    return F.when(F.col("NoteCount") > 1, several.cast("string")).otherwise(F.col("Note"))
