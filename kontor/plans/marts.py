"""Mart round trip: export a mart to CSV, re-import it into an empty clone.

Export is a distributed CSV write (one part file per task; ``single_file``
only on request for small marts).  Import reads with the mart's declared
schema -- never inferred -- and appends into a fresh clone of the table
(same schema, no rows), so a round trip changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sinks.files import append_parquet, clone_empty, write_csv, write_parquet
from ..sources.csv import read_declared


def export_mart(df: DataFrame, path: str, sep: str = ";", single_file: bool = False) -> str:
    return write_csv(df, path, sep=sep, header=True, mode="overwrite", single_file=single_file)


def import_mart(spark: SparkSession, csv_path: str, schema: T.StructType, table_path: str,
                sep: str = ";") -> DataFrame:
    """Drop-and-recreate an empty clone at ``table_path``, append the CSV rows, read it back."""
    write_parquet(clone_empty(spark.createDataFrame([], schema)), table_path, mode="overwrite")
    append_parquet(read_declared(spark, csv_path, schema, sep=sep), table_path)
    return spark.read.schema(schema).parquet(table_path)
