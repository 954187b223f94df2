"""A look at what a layer holds."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

SCHEMA_ROWS = "position bigint, column_name string, data_type string"


class LayerCheck(NamedTuple):
    schema: DataFrame
    sample: DataFrame


def verify_layer(df: DataFrame, rows: int = 5) -> LayerCheck:
    """A table's columns as rows, and a few of its rows in no set order."""
    fields = [
        (position, field.name, field.dataType.simpleString())
        for position, field in enumerate(df.schema, start=1)
    ]
    return LayerCheck(df.sparkSession.createDataFrame(fields, SCHEMA_ROWS), df.limit(rows))
