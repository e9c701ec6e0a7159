"""Report layouts: a grid with section headers and side-by-side column groups, as rows."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.functions.parse import roster_cell


def read_grid(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, cells) of CSV files without a header, of any width; a leading byte-order mark is dropped.

    A file is parsed as a whole, so a quoted cell may hold line breaks; ``line`` counts records.
    """
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        csv.field_size_limit(1 << 30)
        for batch in batches:
            for file, text in zip(batch["file"], batch["value"], strict=True):
                records = csv.reader(io.StringIO(text.removeprefix("\ufeff"), newline=""))
                found = [(file, i, [cell.strip() for cell in record]) for i, record in enumerate(records)]
                yield pd.DataFrame(found, columns=["file", "line", "cells"])

    return files.mapInPandas(parse, "file string, line int, cells array<string>")


def cell(cells: Column, place: int) -> Column:
    """A cell of a record, '' beyond its end."""
    return F.coalesce(F.get(cells, F.lit(place)), F.lit(""))


def depth_tiers(grid: DataFrame, headers: Mapping[str, str], tiers: Sequence[tuple[int, int]], skipped: Sequence[str] = ("REMAINING FA", "GONE")) -> DataFrame:
    """(team, name, position, depth_rank, draft_pick): players of side-by-side tiers under team headers.

    ``headers`` maps a header's text to its team; ``tiers`` are (column, rank).
    The line below a header is its sub-header. Tiers end on lines of their own.
    """
    first = cell(F.col("cells"), 0)
    codes = F.create_map(*[F.lit(x) for pair in headers.items() for x in pair])
    section = Window.partitionBy("file").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    marked = grid.withColumn("_header", F.try_element_at(codes, first)).withColumn("team", F.last("_header", ignorenulls=True).over(section))
    marked = marked.withColumn("_start", F.last(F.when(F.col("_header").isNotNull(), F.col("line")), ignorenulls=True).over(section))
    body = marked.where(F.col("team").isNotNull() & (F.col("line") >= F.col("_start") + 2))
    cells = F.array(*[F.struct(F.lit(rank).alias("depth_rank"), cell(F.col("cells"), column).alias("cell"), cell(F.col("cells"), column + 1).alias("position")) for column, rank in tiers])
    each = body.select("file", "line", "team", F.explode(cells).alias("t")).select("file", "line", "team", "t.*")
    skip = F.lit(False)
    for words in skipped:
        skip = skip | F.upper("cell").startswith(words)
    named = each.where(~skip).withColumn("_p", roster_cell(F.col("cell"))).where(F.col("_p").isNotNull())
    return named.select("team", "_p.name", F.nullif("position", F.lit("")).alias("position"), "depth_rank", "_p.draft_pick", "file", "line")


def filled_positions(rows: DataFrame, order: str, section: Sequence[str], position: str) -> DataFrame:
    """Rows of a table in which a position stands once above its continuation lines: filled down, and depth counted on."""
    from gridloom.operators.relational import fill_down, running_index

    blank_as_null = rows.withColumn(position, F.nullif(F.trim(position), F.lit("")))
    return running_index(fill_down(blank_as_null, section, [order], position, "filled_position"), [*section, "filled_position"], [order], "depth")
