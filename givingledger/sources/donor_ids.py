"""The optional list of donors to export, given as XML."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = "GuidList"
ELEMENT = "Guid"
ELEMENTS = f"{ELEMENT} array<string>"
COMMENTS = r"(?s)<!--.*?-->"


def donor_ids_from_documents(documents: DataFrame, xml: str, id_type: str = "string") -> DataFrame:
    """One ``ProfileID`` row per ``/GuidList/Guid`` element of a column of documents.

    An empty element gives a NULL, so a document that has elements never counts as an empty list.
    NULL documents, and documents with another root, give no rows.
    """
    lists = documents.filter(F.xpath_boolean(xml, F.lit(f"/{ROOT}")))
    return _elements(lists.select(F.from_xml(xml, ELEMENTS).alias("List")), id_type)


def read_donor_ids(spark: SparkSession, path: str, id_type: str = "string") -> DataFrame:
    """The same from XML files, which many tasks can read: a file is cut after each ``Guid`` element.

    The root is checked apart: files whose first element is another than ``GuidList`` give no rows. An element other than ``Guid`` within
    a list is an error, since its ids might be meant or not, and a list without ids means all donors.
    """
    chunks = spark.read.option("lineSep", f"</{ELEMENT}>").text(path)
    bare = F.regexp_replace("value", COMMENTS, "")
    pieces = chunks.select(F.col("_metadata.file_path").alias("File"), bare.alias("Text"))
    opens = F.regexp_like("Text", F.lit(rf"^[\s\uFEFF]*(<\?[^>]*>\s*)*<{ROOT}[\s/>]"))
    other = F.regexp_extract("Text", rf"<(?!/?{ROOT}[\s/>])(?!{ELEMENT}[\s/>])(?!\?)[^>]*>", 0)
    files = pieces.groupBy("File").agg(F.max(opens.cast("int")).alias("IsList"), F.max((other != "").cast("int")).alias("HasOther"))
    lists = files.filter("IsList = 1").select(
        "File", F.when(F.col("HasOther") == 1, F.raise_error(F.concat(F.lit("other elements in "), F.col("File"))).cast("int")).alias("Checked"))
    found = F.regexp_extract_all("Text", F.lit(rf"<{ELEMENT}\s*/>|<{ELEMENT}(?:\s[^>]*)?>[^<]*$"), 0)
    ids = pieces.select("File", F.explode(found).alias("Tagged")).join(F.broadcast(lists), "File").filter("Checked IS NULL")  # a row for each file, which the driver lists anyway
    return _plain(ids.select(F.regexp_extract("Tagged", ">([^<]*)$", 1).alias("ProfileID")), id_type)


def plain_id(value: Column) -> Column:
    """Id text as it is compared: trimmed and in lower case."""
    return F.lower(F.trim(value))


def _elements(lists: DataFrame, id_type: str) -> DataFrame:
    return _plain(lists.select(F.explode(f"List.{ELEMENT}").alias("ProfileID")), id_type)


def _plain(found: DataFrame, id_type: str) -> DataFrame:
    known = F.nullif(plain_id(F.col("ProfileID")), F.lit(""))
    return found.select(known.cast(id_type).alias("ProfileID"))
