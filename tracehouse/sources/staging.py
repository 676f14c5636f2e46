"""Tables on shared storage that end a lineage: a lost executor costs no recomputation of what is behind them."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame

from tracehouse.session import shared_folder


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the session's shared folder, and read back."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
