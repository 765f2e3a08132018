"""Slices replaced as a whole: written aside, then swapped in by renames.

A writer's job writes the new slices below ``<base>/_swap/<id>/new`` (a name
that readers of the table pass over).  When all are complete, a journal file
appears beside them by a rename, and only then is anything that readers see
touched: each old slice is renamed away and the new one renamed to its place.

A writer killed before the journal leaves every old slice as it was.  One killed
after it leaves a journal; ``recover``, which readers and writers of this
package call first, goes on where it stopped, so several slices change together.
What is left of dead writers is removed after ``KEEP_SECONDS``.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from tallyhouse.sources import files

KEEP_SECONDS = 24 * 3600


def _swap(base: str, name: str = "") -> str:
    return f"{base.rstrip('/')}/_swap{name and '/' + name}"


def replace(spark: SparkSession, base: str, write: Callable[[str], list[str]]) -> None:
    """``write(folder)`` writes slices below ``folder`` and returns their paths
    relative to it; these then replace the slices of the same paths below ``base``."""
    recover(spark, base)
    name = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    slices = write(_swap(base, f"{name}/new"))
    files.put_text(spark, _swap(base, f"{name}/journal"), json.dumps(slices))
    _roll(spark, base, name)


def _roll(spark: SparkSession, base: str, name: str) -> None:
    """Bring the journal's slices into place; those that are there already stay."""
    for rel in json.loads(files.read_text(spark, _swap(base, f"{name}/journal"))):
        new, live, old = _swap(base, f"{name}/new/{rel}"), f"{base.rstrip('/')}/{rel}", _swap(base, f"{name}/old/{rel}")
        if not files.exists(spark, new):
            continue
        if files.exists(spark, live):
            files.rename(spark, live, old)
        files.rename(spark, new, live)
    files.delete(spark, _swap(base, f"{name}/journal"))
    files.delete(spark, _swap(base, name))


def recover(spark: SparkSession, base: str) -> None:
    """Finish the swaps of writers that stopped in the middle, oldest first."""
    for name in files.children(spark, _swap(base)):
        if files.exists(spark, _swap(base, f"{name}/journal")):
            _roll(spark, base, name)
        elif int(name.split("-")[0]) < time.time_ns() - KEEP_SECONDS * 10 ** 9:
            files.delete(spark, _swap(base, name))
