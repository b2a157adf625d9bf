"""Stage tables, history, reports and upload files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from stockloom.sources.readers import load_csv_typed

# Upload file limit and the display names of upload columns.
UPLOAD_ROWS_PER_FILE = 999_999
DISPLAY_NAMES = {
    "trumping_level": "Trumping Level",
    "store_group": "Store Group",
    "volume_id": "Volume Id",
    "velocity_id": "Velocity Id",
    "sku_grp": "SKU Grp",
    "parm_code": "Parm code",
    "parm_value": "Parm Value",
    "eff_begin_date": "Eff Begin date",
    "eff_end_date": "Eff End date",
    "start_fscl_wk_nbr": "Start Fscl Wk nbr",
    "end_fscl_wk_nbr": "End Fscl Wk nbr",
    "param_desc": "Param Desc",
    "ootl_reason_code": "OOTL Reason Code",
}


def write_stage(df: DataFrame, path: str) -> None:
    """Replace a stage table.  The path must not be one the frame reads."""
    df.write.mode("overwrite").parquet(path)


def replace_table(spark: SparkSession, csv_path: str, schema: StructType | str, path: str) -> DataFrame:
    """Replace a preference table by a CSV file with declared column types.

    A file that does not fit the types fails the write, and the committer keeps
    a half-written table from being read.  Returns the new table.
    """
    write_stage(load_csv_typed(spark, csv_path, schema), path)
    return spark.read.schema(schema).parquet(path)


def append_history(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Append a run to a history partitioned by its week."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def append_tagged(history: DataFrame, batch: DataFrame, tag: str, value) -> DataFrame:
    """History plus a batch stamped with its load date."""
    stamped = batch.withColumn(tag, F.lit(value))
    return history.unionByName(stamped, allowMissingColumns=False)


def rename_display(df: DataFrame, names: Mapping[str, str] = DISPLAY_NAMES) -> DataFrame:
    """Column names as the upload tool expects them."""
    return df.withColumnsRenamed(dict(names))


def export_delimited(df: DataFrame, path: str, sep: str = "\t", quote: bool = False) -> None:
    """Report files with a header, by default tab-separated and unquoted."""
    writer = df.write.mode("overwrite").option("sep", sep).option("header", True)
    if not quote:
        writer = writer.option("quote", "")
    writer.csv(path)


def export_chunked(
    df: DataFrame, path: str, rows_per_file: int = UPLOAD_ROWS_PER_FILE, sep: str = ","
) -> None:
    """Upload files of limited length, unquoted, NULL as empty text.

    Tasks write in parallel and Spark numbers the files; each task starts a
    new one at the limit, so no file exceeds it.
    """
    (
        df.write.mode("overwrite")
        .option("maxRecordsPerFile", rows_per_file)
        .option("header", True)
        .option("sep", sep)
        .option("quote", "")
        .option("nullValue", "")
        .option("emptyValue", "")
        .csv(path)
    )
