"""What the operators share: reading tables, shipping this package, splitting words."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_PACKAGE = Path(__file__).resolve().parent.parent
_SHIPPED = "_rosterweave_shipped"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give executors this package, once per context; they need not share the driver's folders."""
    context = spark.sparkContext
    if not getattr(context, _SHIPPED, False):
        base = f"{tempfile.mkdtemp(prefix='rosterweave-ship-')}/{_PACKAGE.name}"
        context.addPyFile(
            shutil.make_archive(base, "zip", root_dir=_PACKAGE.parent, base_dir=_PACKAGE.name)
        )
        setattr(context, _SHIPPED, True)


_kept: dict[tuple, object] = {}
_keepers: list[str] = []  # the module whose tasks use what is kept


def kept(make: Callable) -> Callable:
    """Like ``functools.cache``, for what the tasks of a Python worker share, one after the other.

    Workers outlive a stage, so it goes when the worker gets a task of another module.
    """

    @wraps(make)
    def get(*given):
        key = (make.__module__, make.__qualname__, *given)
        if key not in _kept:
            _kept[key] = make(*given)
        return _kept[key]

    return get


def begin_task(module: str) -> None:
    """Drop what tasks of other modules have kept in this worker."""
    if _keepers != [module]:
        _kept.clear()
        _keepers[:] = [module]


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand on every executor."""
    ship(df.sparkSession)
    module = function.__module__

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task(module)
        yield from function(batches)
        pa.default_memory_pool().release_unused()  # the worker waits for other tasks now

    return df.mapInArrow(run, schema)


def parts(batches: Iterable[pa.RecordBatch], size: int = 1_000) -> Iterator[pa.RecordBatch]:
    """The batches in slices of ``size`` rows at most, so that few texts at once are Python objects."""
    for batch in batches:
        for first in range(0, len(batch), size):
            yield batch.slice(first, size)


def numbered(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` with a number per row, as ids may be null or repeated.

    The number is steady only within one evaluation: store the frame before using it twice.
    """
    return docs.select(F.monotonically_increasing_id().alias("row"), *columns)


def rows(batches: Iterable[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples, a batch in memory at a time."""
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns))


def text_mark() -> Column:
    """Hash of ``text`` that, next to the id, tells rows with one id apart."""
    return F.xxhash64("text").alias("mark")


def rows_of(docs: DataFrame, keys: DataFrame, how: str, distinct: bool = False) -> DataFrame:
    """Rows of ``docs`` whose ``doc_id`` and text are (or are not) among ``keys (doc_id, mark)``.

    ``how`` is left_semi or left_anti. With ``distinct`` rows with equal ids and texts leave one.
    """
    id_, none, mark = (f"_key_{x}" for x in ("id", "none", "mark"))
    named = {id_: F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), none: F.col("doc_id").isNull()}
    wanted = keys.withColumns(named).select(id_, none, F.col("mark").alias(mark))
    kept = docs.withColumns(named | {mark: text_mark()}).join(wanted, [id_, none, mark], how)
    if distinct:
        kept = kept.dropDuplicates([id_, none, mark])
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
