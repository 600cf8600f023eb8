"""Loading of the generated tables and the fixed dates of the queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values.
AS_OF_ORDERS = dt.date(2001, 6, 15)
AS_OF_EVENTS = dt.date(2024, 1, 20)
CITY = "ASIA"
SEGMENTS = {
    "AUTOMOBILE": "auto",
    "BUILDING": "building",
    "FURNITURE": "furniture",
    "HOUSEHOLD": "household",
    "MACHINERY": "machinery",
}
PRIORITIES = {
    "1-URGENT": "urgent",
    "2-HIGH": "high",
    "3-MEDIUM": "medium",
    "4-NOT SPECIFIED": "unspecified",
    "5-LOW": "low",
}


class Tables:
    """Lazy access to the tables of one folder: ``Tables(spark, folder).orders``. A table's
    file footers are read once per instance, at its first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self._folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        df = self.spark.read.parquet(f"{self._folder}/{name}.parquet")
        setattr(self, name, df)
        return df

    def city_nations(self) -> DataFrame:
        """Nations of our city: ``n_nationkey, n_name``."""
        city = self.region.where(F.col("r_name") == CITY).select("r_regionkey")
        return self.nation.join(
            city, F.col("n_regionkey") == F.col("r_regionkey"), "left_semi"
        ).select("n_nationkey", "n_name")
