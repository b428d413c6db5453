"""Names for sources, views and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from lakesteps.sources.writers import replace


class Catalog:
    """Layer names to DataFrames: views are recomputed on read, tables are written once."""

    def __init__(self, spark: SparkSession, warehouse: str):
        self.spark, self.warehouse = spark, warehouse.rstrip("/")

    def register(self, name: str, df: DataFrame) -> DataFrame:
        df.createOrReplaceTempView(name)
        return df

    view = register

    def source(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def table(self, name: str, df: DataFrame, order: Sequence[str] = ()) -> DataFrame:
        """Build the whole table anew, even from itself, and return it as read back.

        With ``order`` the files hold ranges of those columns, so that filters on them skip files.
        """
        path = f"{self.warehouse}/{name}"
        if order:
            df = df.repartitionByRange(*order).sortWithinPartitions(*order)
        replace(df, path)
        return self.register(name, self.spark.read.schema(df.schema).parquet(path))
