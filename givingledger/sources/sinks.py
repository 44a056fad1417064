"""Writing the export."""

from __future__ import annotations

from pyspark.sql import DataFrame

SINK_FORMATS = ("parquet", "orc", "csv", "json")


def write_export(
    export: DataFrame, path: str, file_format: str = "parquet", mode: str = "errorifexists"
) -> None:
    """Write in parallel, one file per partition. CSV files carry a header each."""
    if file_format not in SINK_FORMATS:
        raise ValueError(f"format must be one of {SINK_FORMATS}, not {file_format!r}")
    writer = export.write.format(file_format).mode(mode)
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.save(path)
