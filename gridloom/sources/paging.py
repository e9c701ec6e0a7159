"""Paged and per-entity interfaces. The transport is a function that is passed in; nothing here opens a connection.

Requests are spread over the cluster: a table of request arguments is mapped
by partition, each answer is one row of JSON text, and parsing is Spark's.
"""

from __future__ import annotations

import json
import random
import time
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from gridloom.operators.ordering import ranked
from gridloom.session import cut_lineage


class Refused(Exception):
    """An answer that no retry will change."""


def backoff(attempt: int, first_wait: float, most: float = 60.0, spread: float = 0.25, chance: Callable[[], float] = random.random) -> float:
    """Seconds before the next try: doubled each time up to ``most``, and up to ``spread`` more so that many callers don't return together."""
    return min(first_wait * 2**attempt, most) * (1 + spread * chance())


def status_hint(status: int, headers: Mapping[str, str], attempt: int, last: int) -> None:
    """Raises what an answer's status means: nothing for success, ``Refused`` for what a retry can't change, else an error to retry.

    A first 403 may be a guard against haste and is tried again; one that comes back on the last try is a refusal.
    """
    if 200 <= status < 300:
        return
    if status in (400, 401, 404, 410, 422) or (status == 403 and attempt >= last):
        raise Refused(f"status {status}")
    problem = RuntimeError(f"status {status}")
    wait = {k.lower(): v for k, v in headers.items()}.get("retry-after", "")
    problem.wait = float(wait) if wait.isdigit() else None  # type: ignore[attr-defined]
    raise problem


def with_retries(call: Callable[[], str], tries: int = 3, first_wait: float = 1.0, wait: Callable[[float], None] = time.sleep, wait_hint: Callable[[Exception], float | None] = lambda problem: getattr(problem, "wait", None)) -> str:
    """The call's answer; waits before each further try as ``backoff`` says, or as long as the failure itself asks for."""
    for attempt in range(tries):
        try:
            return call()
        except Refused:
            raise
        except Exception as problem:
            if attempt == tries - 1:
                raise
            hinted = wait_hint(problem)
            wait(backoff(attempt, first_wait) if hinted is None else hinted)
    raise ValueError("tries must be at least 1")


def counted_pages(
    fetch: Callable[[int, int], dict], size: int, items: str = "items", total: str = "total", dedupe_by: str | None = None,
    key: str = "id", min_total: int = 0, validate: Callable[[dict], bool] | None = None,
) -> list[dict]:
    """All items of an interface with offset, limit and a total; pages until the total or an empty page.

    Refused are: a total below ``min_total``, fewer items than the total, an item
    that ``validate`` turns down, and the same ``key`` twice unless ``dedupe_by``
    says by what repeated items are to be dropped (the first stays).
    """
    found: list[dict] = []
    said = 0
    while True:
        page = fetch(len(found), size)
        got = page.get(items) or []
        found += got
        said = page.get(total, said)
        if not got or (total in page and len(found) >= said):
            break
    if max(said, len(found)) < min_total or len(found) < said:
        raise Refused(f"{len(found)} of {said} items, at least {min_total} expected")
    if validate is not None and not all(map(validate, found)):
        raise Refused("an item doesn't have the form expected")
    if dedupe_by:
        first: dict = {}
        for item in found:
            first.setdefault(item[dedupe_by], item)
        return list(first.values())
    keys = [item[key] for item in found if key in item]
    if len(set(keys)) < len(keys):
        raise Refused(f"{len(keys) - len(set(keys))} items of {len(keys)} repeat a {key}")
    return found


def bulk_or_each(bulk: Callable[[], list[dict]], each: Callable[[str], list[dict]], parts: Sequence[str], key: str = "id") -> tuple[list[dict], bool]:
    """Items of one large answer, or part by part where that fails or is empty; and whether it was the large one. A key counts once."""
    try:
        found, whole = bulk(), True
    except Exception:  # whatever kept the large answer from coming, the parts are tried
        found, whole = [], False
    if not found:
        found, whole = [item for part in parts for item in each(part)], False
    return list({item.get(key, i): item for i, item in enumerate(found)}.values()), whole


def followed_refs(start: str, fetch: Callable[[str], dict], refs: str = "items", ref: str = "$ref") -> list[dict]:
    """Documents that are reached from ``start`` by following references of any depth; each address is fetched once.

    A document without references is a leaf and is returned with its address.
    """
    seen, waiting, leaves = {start}, [start], []
    while waiting:
        address = waiting.pop(0)
        document = fetch(address)
        onward = [r[ref] for r in document.get(refs) or [] if isinstance(r, dict) and ref in r]
        if not onward and refs not in document:
            leaves.append({"address": address, **document})
        for target in onward:
            if target not in seen:
                seen.add(target)
                waiting.append(target)
    return leaves


def numbered_pages(fetch: Callable[[int], dict], items: str = "items", pages: str = "total_pages") -> list[dict]:
    """All items of an interface with page numbers."""
    first = fetch(1)
    found = list(first.get(items) or [])
    for number in range(2, int(first.get(pages) or 1) + 1):
        found += fetch(number).get(items) or []
    return found


def cursor_pages(fetch: Callable[[str | None], dict], items: str = "items", cursor: str = "next") -> list[dict]:
    """All items of an interface that names its next page."""
    found, at, seen = [], None, set()
    while True:
        page = fetch(at)
        found += page.get(items) or []
        at = page.get(cursor)
        if not at or at in seen:
            return found
        seen.add(at)


def fetch_each(requests: DataFrame, key: str, fetch: Callable[[str], str], failures_allowed: float = 0.1, tries: int = 3, first_wait: float = 1.0) -> DataFrame:
    """(key, body, problem) per request; at most the given share may fail, checked before anything is used.

    Requests run where their partition is; ``fetch`` takes the key as text.
    """
    rows = requests.select(F.col(key).cast("string").alias("k"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for k in batch["k"]:
                try:
                    found.append((k, with_retries(lambda k=k: fetch(k), tries, first_wait), None))
                except Exception as problem:
                    found.append((k, None, type(problem).__name__))
            yield pd.DataFrame(found, columns=["k", "body", "problem"])

    answers = cut_lineage(rows.mapInPandas(run, "k string, body string, problem string"))
    share = answers.agg(F.avg(F.col("problem").isNotNull().cast("double"))).first()[0] or 0.0
    if share > failures_allowed:
        raise Refused(f"{share:.0%} of the requests failed")
    return answers.withColumnRenamed("k", key)


def in_chunks(ids: DataFrame, key: str, size: int) -> DataFrame:
    """(chunk, keys): ids in order, ``size`` at a time and no more, joined by commas for interfaces that take several at once."""
    placed = ranked(ids.select(key), key).withColumn("chunk", F.floor(F.col("rank") / size))
    return placed.groupBy("chunk").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", F.col(key).cast("string").alias("k")))), lambda x: x["k"]), ",").alias("keys"))


class PagedSource(DataSource):
    """A paged interface as a Spark source: ``spark.dataSource.register(paged_source(...))``, then ``spark.read.format(name).load()``.

    Every page is a partition of its own and is read where its task runs; one row is an item as JSON text with its page and place.
    Subclasses come from ``paged_source``.
    """

    pages: Callable[[], Sequence[str]]
    fetch: Callable[[str], list[dict]]
    label = "paged"

    @classmethod
    def name(cls) -> str:
        return cls.label

    def schema(self) -> str:
        return "page string, place int, item string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _PageReader(type(self).pages, type(self).fetch)


class _PageReader(DataSourceReader):
    def __init__(self, pages: Callable[[], Sequence[str]], fetch: Callable[[str], list[dict]]) -> None:
        self.pages, self.fetch = pages, fetch

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(page) for page in self.pages()]

    def read(self, partition: InputPartition) -> Iterator[tuple[str, int, str]]:
        for i, item in enumerate(self.fetch(partition.value)):
            yield partition.value, i, json.dumps(item)


def paged_source(label: str, pages: Callable[[], Sequence[str]], fetch: Callable[[str], list[dict]]) -> type[PagedSource]:
    """A source named ``label``: ``pages`` lists the pages' names (offsets, numbers, references), ``fetch`` gives a page's items."""
    return type(f"Paged_{label}", (PagedSource,), {"label": label, "pages": staticmethod(pages), "fetch": staticmethod(fetch), "__module__": __name__})


def rows_of(spark: SparkSession, items: list[dict], schema: str) -> DataFrame:
    """Items of a small interface as a table."""
    texts = [(json.dumps(i),) for i in items]
    return spark.createDataFrame(texts, "t string").select(F.from_json("t", schema).alias("r")).select("r.*")
