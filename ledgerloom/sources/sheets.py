"""Dirty sheets to records: blank rows, repeated headings, continuation rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import clean_spaces
from ledgerloom.operators.ranking import carry_forward

# What a left-over heading reads in the number column.
HEADING_CELLS = ["nr", "nr.", ""]


def cleaned_cells(columns) -> Column:
    """All cells of a row, cleaned, as one array.

    Row predicates over the array stay one expression for the optimizer, where
    predicates over many renamed columns would multiply during inference.
    """
    return F.array(*[clean_spaces(F.col(f"`{c}`")) for c in columns])


def is_blank(cells) -> Column:
    return ~F.exists(cells, lambda cell: cell != "")


def is_heading(cells, markers) -> Column:
    """A row is a heading when any marker group matches.

    ``markers`` is a list of groups; a group is a list of patterns that must all
    be found in the lower-cased cells joined by ' | '.
    """
    line = F.lower(F.array_join(cells, " | "))
    any_group = F.lit(False)
    for group in markers:
        every = F.lit(True)
        for pattern in group:
            every = every & line.rlike("(?U)" + pattern)
        any_group = any_group | every
    return any_group


def kept_rows(grid: DataFrame, columns, heading_markers=()) -> DataFrame:
    """Rows that are neither blank nor a heading, with their ``cells``."""
    rows = grid.withColumn("cells", cleaned_cells(columns)).drop(*columns)
    rows = rows.filter(~is_blank("cells"))
    return rows.filter(~is_heading(F.col("cells"), heading_markers)) if heading_markers else rows


def stitch_records(
    grid: DataFrame, columns, heading_markers=(), source: str = "source", block: str = "block", pos: str = "pos"
) -> DataFrame:
    """One row per record.

    A row whose first cell is all digits starts a record; every later row up to
    the next start appends its non-empty cells with a space. Rows ahead of the
    first start, blank rows and headings are dropped. Result: ``source``,
    ``record`` (block and position of the start row), then the columns.
    """
    rows = kept_rows(grid, columns, heading_markers)
    # The order of a row within its source: block first, then position.
    placed = rows.withColumn("__place", F.struct(F.col(block).alias("block"), F.col(pos).alias("pos")))
    marked = placed.withColumn("__start", F.when(F.col("cells")[0].rlike(r"^\d+$"), F.col("__place")))
    owned = carry_forward(marked, "__start", "record", source, block, pos).filter(F.col("record").isNotNull())
    pieces = F.sort_array(F.collect_list(F.struct("__place", "cells")))
    whole = owned.groupBy(source, "record").agg(pieces.alias("__pieces"))

    def cell(i):
        texts = F.transform(F.col("__pieces"), lambda p: p["cells"][i])
        return F.array_join(F.filter(texts, lambda t: t != ""), " ")

    records = whole.select(source, "record", *[cell(i).alias(c) for i, c in enumerate(columns)])
    return records.filter(~F.lower(F.col(f"`{columns[0]}`")).isin(HEADING_CELLS))


def type_records(records: DataFrame, typed: dict) -> DataFrame:
    """Apply ``{column: Column -> Column}`` after stitching."""
    return records.withColumns({c: rule(F.col(f"`{c}`")) for c, rule in typed.items()})
