"""Tables, keyed exports, reports and sidecars. Every file is written beside its place and moved there."""

from __future__ import annotations

import json
import os
import tempfile
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def replace_table(df: DataFrame, path: str, stamp: Column | None = None, partition_by: Sequence[str] = ()) -> None:
    """Overwrites a parquet table, with a load stamp."""
    stamped = df.withColumn("loaded_at", stamp if stamp is not None else F.current_timestamp())
    stamped.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replaces the partitions that ``df`` has rows of and keeps the others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def keyed_json_lines(df: DataFrame, key: str, order: str) -> DataFrame:
    """(value) one line {"key": record} per row in export order; nulls stay as null fields.

    Lines keep the export distributed; a single object is a matter of joining them.
    """
    record = F.to_json(F.struct(*[F.col(c) for c in df.columns if c != order]), {"ignoreNullFields": "false"})
    quoted = F.to_json(F.struct(F.col(key).cast("string").alias("k")))
    name = F.regexp_replace(F.regexp_replace(quoted, r'^\{"k":', ""), r"\}$", "")
    return df.select(F.col(order).alias("_o"), F.concat(F.lit("{"), name, F.lit(":"), record, F.lit("}")).alias("value")).orderBy("_o").select("value")


#: Rows and letters that a single keyed object may have.
OBJECT_ROWS, OBJECT_LETTERS = 100_000, 256_000_000


def keyed_object(df: DataFrame, key: str, most_rows: int = OBJECT_ROWS, most_letters: int = OBJECT_LETTERS) -> DataFrame:
    """One row with the whole keyed object as JSON, for a table that fits one task (a league's master); a larger one is refused."""
    record = F.struct(*[F.col(c) for c in df.columns if c != key])
    size = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length(F.to_json(record))), F.lit(0)).alias("letters")).first()
    if size["n"] > most_rows or size["letters"] > most_letters:
        raise ValueError(f"{size['n']} rows of {size['letters']} letters are too many for one object; export keyed lines")
    return df.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(key).cast("string").alias("k"), record.alias("v")))))).alias("value"))


def unmatched_report(df: DataFrame, name: str, detail: Mapping[str, str]) -> DataFrame:
    """(value) sorted lines "Name (label=value, ...)"."""
    parts = [F.concat(F.lit(f"{label}="), F.coalesce(F.col(c).cast("string"), F.lit("None"))) for label, c in detail.items()]
    return df.select(F.concat(F.col(name), F.lit(" ("), F.concat_ws(", ", *parts), F.lit(")")).alias("value")).distinct().orderBy("value")


def write_atomically(path: str, text: str) -> None:
    """Writes beside the place and renames, so that no reader sees half a file."""
    folder = os.path.dirname(path) or "."
    os.makedirs(folder, exist_ok=True)
    handle, beside = tempfile.mkstemp(dir=folder)
    try:
        with os.fdopen(handle, "w", encoding="utf-8") as out:
            out.write(text)
        os.replace(beside, path)
    except BaseException:
        if os.path.exists(beside):
            os.unlink(beside)
        raise


def write_json(path: str, value: object, compact: bool = False) -> None:
    """An object as JSON text."""
    write_atomically(path, json.dumps(value, ensure_ascii=False, separators=(",", ":") if compact else None, indent=None if compact else 1))


def merge_sidecar(path: str, changes: Mapping[str, object]) -> dict:
    """Updates some keys of a sidecar and keeps the others."""
    held = {}
    if os.path.exists(path):
        with open(path, encoding="utf-8") as stored:
            held = json.load(stored)
    held |= changes
    write_json(path, held)
    return held


def append_log(path: str, line: str) -> None:
    """Adds a line to a log."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "a", encoding="utf-8") as log:
        log.write(line.rstrip("\n") + "\n")


def enrich_map(df: DataFrame, extra: DataFrame, on: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Rows with some fields replaced from another table; rows without a counterpart get null."""
    return df.drop(*fields).join(extra.select(*on, *fields), list(on), "left")
