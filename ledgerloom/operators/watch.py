"""Counts taken while a table is written, in place of extra passes over it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

WATCHED_SCHEMA = "section string, metric string, value long"


class Watch:
    """Collects facts of the frames passed through it; they are known once one action has run over the last frame.

    Each fact is one number a task, so nothing but those numbers reaches the driver.
    """

    def __init__(self):
        self.taken: list[tuple[str, Observation]] = []

    def _observe(self, df: DataFrame, section: str, facts: dict[str, Column]) -> DataFrame:
        told = Observation()
        self.taken.append((section, told))
        return df.observe(told, *[c.cast("long").alias(name) for name, c in facts.items()])

    def rows(self, df: DataFrame, section: str, filled=()) -> DataFrame:
        """The frame, with its ``rows`` and the values that are not NULL (``filled <column>``) counted."""
        facts = {"rows": F.count(F.lit(1))} | {f"filled {c}": F.count(F.col(f"`{c}`")) for c in filled}
        return self._observe(df, section, facts)

    def parsed(self, df: DataFrame, section: str, into: dict[str, Column], given: dict[str, str]) -> DataFrame:
        """The frame with the columns ``into``, and how many values of their sources (``given``) were read and ``lost``.

        A value is lost where the source is neither NULL nor blank and the result is NULL.
        """
        out = df.withColumns({f"__given_{i}": F.trim(F.col(f"`{given[c]}`").cast("string")) != "" for i, c in enumerate(into)}).withColumns(into)
        facts = {}
        for i, c in enumerate(into):
            present = F.coalesce(F.col(f"__given_{i}"), F.lit(False))
            facts |= {f"read {c}": F.count(F.col(f"`{c}`")), f"lost {c}": F.count_if(present & F.col(f"`{c}`").isNull())}
        return self._observe(out, section, facts).drop(*[f"__given_{i}" for i in range(len(into))])

    def facts(self) -> list[tuple[str, str, int]]:
        """``(section, metric, value)`` in the order of the sections; waits for the action."""
        return [(section, metric, int(value)) for section, told in self.taken for metric, value in told.get.items()]

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.facts(), WATCHED_SCHEMA)
