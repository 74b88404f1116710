"""SQL over a frame, batch or stream."""

from __future__ import annotations

from pyspark.sql import DataFrame


def sql_transform(df: DataFrame, query: str, name: str = "rows", **parameters: object) -> DataFrame:
    """Run SQL that names the frame as ``{rows}`` (or ``{name}``).

    No view is registered. Values are passed as ``:parameter`` markers.
    """
    return df.sparkSession.sql(query, args=parameters or None, **{name: df})
