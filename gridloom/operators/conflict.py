"""Conflicting attributes of several sources: precedence with provenance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.functions.text import mapped


def precedence(options: Sequence[tuple[str, Column]]) -> Column:
    """Struct (value, source) of the first option that is not null."""
    value = F.coalesce(*[c for _, c in options])
    source = F.lit(None).cast("string")
    for name, c in reversed(options):
        source = F.when(c.isNotNull(), F.lit(name)).otherwise(source)
    return F.struct(value.alias("value"), source.alias("source"))


def granular_position(granular: Column, coarse: Column, groups: Mapping[str, str], known: Sequence[str]) -> Column:
    """A known granular position, else the group of the coarse one, else the group of the granular one, else null."""
    return F.coalesce(F.when(granular.isin(*known), granular), mapped(coarse, groups), mapped(granular, groups))


def rotation(depth_rank: Column, by_minutes: Column, labels: Mapping[int, str]) -> Column:
    """Struct (value, source): depth chart before minutes."""
    label = None
    for rank, text in labels.items():
        label = F.when(depth_rank == rank, F.lit(text)) if label is None else label.when(depth_rank == rank, F.lit(text))
    return precedence([("depth_chart", label), ("minutes", by_minutes)])


def position_group(position: Column, groups: Mapping[str, str], standalone: Sequence[str]) -> Column:
    """Struct (value, source): a standalone position is its own group by default, others are mapped."""
    return F.when(position.isin(*standalone), F.struct(position.alias("value"), F.lit("defaulted").alias("source"))).when(
        mapped(position, groups).isNotNull(), F.struct(mapped(position, groups).alias("value"), F.lit("mapped").alias("source"))
    )


def scheme_slot(slot: Column, scheme: Column, tables: Mapping[str, Mapping[str, str]]) -> Column:
    """Standard position of a slot in its own scheme, else in another scheme, else null."""
    own = None
    for name, table in tables.items():
        own = F.when(scheme == name, mapped(slot, table)) if own is None else own.when(scheme == name, mapped(slot, table))
    return F.coalesce(own, *[mapped(slot, table) for table in tables.values()])


def default_fills(values: Mapping[str, object]) -> dict[str, Column]:
    """Columns with their defaults for null."""
    return {name: F.coalesce(F.col(name), F.lit(default)) for name, default in values.items()}
