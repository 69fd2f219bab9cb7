"""Environment configuration: table names, storage and checkpoint locations (G3, ST2).

One frozen object is passed to every job, so all layers of a run agree on
the environment (trap T15).  Names are two-level (``<env>_<layer>.<table>``)
in the session catalog; every path is under one shared storage root.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Config:
    catalog: str          # e.g. "mobility_dev" / "mobility_prod"
    root: str             # shared storage root (object store / HDFS / local in tests)
    prefix: str = "mobility_"

    @property
    def env(self) -> str:
        return self.catalog.removeprefix(self.prefix)

    def database(self, layer: str) -> str:
        return f"{self.env}_{layer}"

    def table(self, layer: str, name: str) -> str:
        return f"{self.database(layer)}.{name}"

    def data(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{self.env}/{layer}/{name}"

    def checkpoint(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/_checkpoints/{self.env}/{layer}/{name}"

    def schema_store(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/_schemas/{self.env}/{layer}/{name}"

    def landing(self, feed: str) -> str:
        return f"{self.root.rstrip('/')}/raw/{feed}"

    def ensure_databases(self, spark: SparkSession, layers=("bronze", "silver", "gold")) -> None:
        for layer in layers:
            loc = f"{self.root.rstrip('/')}/{self.env}/{layer}.db"
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database(layer)} LOCATION '{loc}'")
