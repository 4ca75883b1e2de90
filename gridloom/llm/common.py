"""Helpers that the operators of this folder share."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.columns import require
from ..functions.storage import cut_lineage

# White space of the word rule of this folder: space and the controls \x09 to \x0D.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """The column of just this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def narrow(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text`` alone: other columns cannot clash; a NULL text is an empty one."""
    require(df, id_col, text_col)
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    return df.select(quoted(id_col).alias("doc_id"), text.alias("text"))


def words(text: Column) -> Column:
    """Array of the runs of characters other than white space."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def once_per_worker(key: tuple, build: Callable):
    """A model that is costly to load, kept for the next tasks of one Python worker.

    Only the last one is kept: a worker that goes on to another operator gives it back.

    Functions travel by value, so their module's globals are new in every task; the
    interpreter's own ``sys`` module is the one place that stays.
    """
    kept = sys.__dict__.setdefault("_gridloom_worker_models", {})
    if key not in kept:
        kept.clear()
        kept[key] = build()
    return kept[key]


def tokenizer_path(name: str) -> str:
    """A path as it is; a bare file name is looked up in the installed vocabulary package."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def parts_of(batch: pa.RecordBatch, rows: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of few rows, so that Python objects of one slice exist at a time."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


# About so many bytes of rows travel to a Python worker at a time.
BATCH_BYTES = 4 << 20
_BATCH_SETTING, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def map_batches(rows: DataFrame, function: Callable, schema) -> DataFrame:
    """``mapInArrow`` over batches bounded by bytes, however long the texts are.

    An executor holds such a batch twice for each of its cores, in the JVM's direct memory and
    in the worker. The bound is a setting of the session, changed only where it stands at
    Spark's default.
    """
    conf = rows.sparkSession.conf
    if conf.get(_BATCH_SETTING, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    return rows.mapInArrow(function, schema)


# A table of at most so many narrow rows is broadcast; beyond it joins shuffle.
BROADCAST_ROWS = 50_000


def fitting(small: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The table as a build side: broadcast where a count shows that it fits, else left alone.

    The rows are written once, so the count and the join read the same ones. Use it for
    narrow rows (keys and numbers).
    """
    small = cut_lineage(small)
    return F.broadcast(small) if small.count() <= rows else small
