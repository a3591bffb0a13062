"""Table readers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CSV_OPTIONS = {"header": "true", "mode": "PERMISSIVE", "enforceSchema": "false"}


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    fmt: str = "parquet",
    optional: bool = False,
    enabled: bool = True,
) -> DataFrame | None:
    """Read a table; a switched-off or absent optional table gives None.

    CSV without a schema costs a pass over the file to infer one, so large
    inputs should pass a schema.
    """
    if not enabled:
        return None
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
        if schema is None:
            reader = reader.option("inferSchema", "true")
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.load(path)
    except AnalysisException as error:
        if optional and error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
