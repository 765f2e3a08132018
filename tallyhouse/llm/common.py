"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types
import uuid
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import ensure_checkpoint_dir
from tallyhouse.sources import files


def ship_by_value(module_name: str) -> None:
    """Send this module's functions to the executors inside the task.

    Executors then need no copy of this package on their import path.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


ship_by_value(__name__)


def worker_state() -> dict:
    """A dict that lives as long as the Python worker process does.

    Shipped functions get fresh globals in each task; caches kept here are
    shared by the tasks that one (reused) worker runs.
    """
    return sys.modules.setdefault("_tallyhouse_worker", types.ModuleType("_tallyhouse_worker")).__dict__


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared checkpoint folder and read it.

    Cuts the lineage at a durable copy: a lost executor costs no recomputation
    and the plan above it runs once.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/tallyhouse-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


_WRITTEN: list[str] = []     # tables of this driver, oldest first


@contextmanager
def scratch(spark: SparkSession):
    """Tables that ``stored`` writes inside the block are deleted at its end, all
    but the last one, which is its result.  After a failure they stay."""
    begin = len(_WRITTEN)
    yield
    for path in _WRITTEN[begin:-1]:
        files.delete(spark, path)
    del _WRITTEN[begin:-1]


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


HOT_SHARE = 1024


def text_key() -> F.Column:
    """SHA-256 of the text (null: of the empty text), as 32 bytes."""
    return F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))


def hot_keys(per_text: DataFrame, total: int) -> list:
    """The keys of ``per_text`` (key, copies) that more than 1 in ``HOT_SHARE`` of
    the ``total`` rows have: fewer than ``HOT_SHARE``."""
    return [r["key"] for r in per_text.filter(F.col("copies") * HOT_SHARE > F.lit(total)).select("key").collect()]


def join_copies(rows: DataFrame, per_text: DataFrame, total: int, hot: list | None = None) -> DataFrame:
    """``rows`` (a row per document) joined by ``key`` with ``per_text``, which
    has one row per key and in ``copies`` the number of its documents.

    A key of more than 1 in ``HOT_SHARE`` of the ``total`` documents is one of
    fewer than ``HOT_SHARE`` such keys: these are broadcast and their documents
    stay where they are.  The others are shuffled, no group of them being larger
    than that share.  Where the caller has asked for these keys (``hot_keys``),
    both are told apart by them, and without any it is a plain join.
    """
    if hot is not None:
        frequent = F.col("key").isin(hot)
        if not hot:
            return rows.join(per_text, "key")
        near = rows.filter(frequent).join(F.broadcast(per_text.filter(frequent)), "key")
        return near.unionByName(rows.filter(~frequent).join(per_text.filter(~frequent), "key"))
    is_hot = F.col("copies") * HOT_SHARE > F.lit(total)
    hot = per_text.filter(is_hot)
    near = rows.join(F.broadcast(hot), "key")
    far = rows.join(F.broadcast(hot.select("key")), "key", "left_anti").join(per_text.filter(~is_hot), "key")
    return near.unionByName(far)
