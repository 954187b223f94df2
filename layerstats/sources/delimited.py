"""Delimited files in, with the file each row came from."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

SOURCE_FILE = "source_file"


def ingest_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    infer_schema: bool = False,
    delimiter: str = ",",
    check_headers: bool = True,
    as_text: Iterable[str] = (),
    malformed: str | None = None,
) -> DataFrame:
    """Read headered delimited files as they are, plus ``source_file``.

    Without ``schema`` every column is text named by the header: no pass over
    the data is needed, and cleaning sees what the file says. ``infer_schema``
    reads all data once more and lets one ``1.5`` in a column of whole numbers
    turn ``420`` into ``420.0``. Columns in ``as_text`` stay text all the same:
    inference would take ``2022-1`` for a date. Names the files lack are ignored.

    Spark maps columns by position, so of several files one with its columns in
    another order would load into the wrong ones. ``check_headers`` makes that
    an error: every file's header must agree with ``schema`` or else with the
    first file's. Turn it off for files with unnamed or repeated columns.

    A line with more fields than columns loses the surplus without a trace, and
    one with fewer gets NULLs, unless ``malformed`` names a further column,
    which holds the text of every line that does not fit and NULL for the rest.
    """
    reader = spark.read.option("header", True).option("sep", delimiter)
    reader = reader.option("enforceSchema", not check_headers)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer_schema:
        reader = reader.option("inferSchema", True)
    text = {name.lower() for name in as_text} if schema is None and infer_schema else set()
    if text or malformed:
        fields = [StructField(f.name, StringType()) if f.name.lower() in text else f for f in reader.csv(path).schema]
        if malformed:
            fields.append(StructField(malformed, StringType()))
            reader = reader.option("columnNameOfCorruptRecord", malformed)
        reader = reader.option("inferSchema", False).schema(StructType(fields))
    # The scan's own metadata survives later joins and shuffles, which a
    # function asking the running task for its input file does not.
    return reader.csv(path).select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))
