"""Rows counted as they pass, by the job that writes them anyway."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


class Counts:
    """How many rows went by at some named places of the plans that were run."""

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def passing(self, df: DataFrame, name: str) -> DataFrame:
        """The same rows, counted under a name when an action runs over them.

        The rows are to be used once in that action's plan; a second use would count again.
        """
        self._seen[name] = Observation(name)
        return df.observe(self._seen[name], F.count(F.lit(1)).alias("rows"))

    def rows(self) -> dict[str, int]:
        """The counts, once the actions are over."""
        return {name: seen.get["rows"] for name, seen in self._seen.items()}

    def report(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows().items()), "step string, row_count bigint")
