"""What earlier loads have given out: surrogate keys by natural key, and the lines loaded."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


class KeyMap:
    """One Parquet folder per table under ``root``, beside the star.

    A dimension's folder holds (natural key, surrogate key); keys once given stay. The fact's
    holds the order and line ids that are in the fact, for a model whose fact lacks them."""

    def __init__(self, root: str):
        self.root = root

    def read(self, spark: SparkSession, name: str) -> DataFrame | None:
        """The map as it is now, or None before the first load."""
        try:
            return spark.read.parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def write(self, name: str, rows: DataFrame, mode: str) -> None:
        rows.write.mode(mode).parquet(f"{self.root}/{name}")
