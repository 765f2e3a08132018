"""Claims: at most one loader works on a slice, whatever driver it runs in.

A claim folder holds numbered files, one per claim ever taken (owner, expiry),
and a ``.done`` file beside each that was given back.  Taking a claim is
creating the next number if it is absent, which one caller alone can do
(compare-and-set).  A claim whose owner died is free again when its lease ends;
the same owner gets its own claim again (a replayed batch).
"""

from __future__ import annotations

import time
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession

from tallyhouse.sinks.writers import slice_path
from tallyhouse.sources import files

LEASE_SECONDS = 6 * 3600


@dataclass(frozen=True)
class Claim:
    folder: str
    number: int
    owner: str


def month_folder(fact_path: str, run_month: str) -> str:
    """Where claims on one month of a fact table are: inside it, under a name
    that readers of the table pass over."""
    return slice_path(f"{fact_path.rstrip('/')}/_claims", {"RunMonth": run_month})


def _numbers(spark: SparkSession, folder: str) -> tuple[list[int], set[int]]:
    names = files.children(spark, folder)
    return ([int(n) for n in names if n.isdigit()],
            {int(n[:-5]) for n in names if n.endswith(".done") and n[:-5].isdigit()})


def _file(folder: str, number: int) -> str:
    return f"{folder}/{number:012d}"


def acquire(spark: SparkSession, folder: str, owner: str, lease: float = LEASE_SECONDS) -> Claim | None:
    """The claim, or None while another owner holds it."""
    taken, done = _numbers(spark, folder)
    last = max(taken, default=0)
    if last and last not in done:
        held = (files.read_text(spark, _file(folder, last)) or "").split("\n")
        if held[0] == owner:
            return Claim(folder, last, owner)
        if len(held) < 2 or float(held[1]) > time.time():       # no text yet: it is being written
            return None
    mine = Claim(folder, last + 1, owner)
    if not files.create_new(spark, _file(folder, mine.number), f"{owner}\n{time.time() + lease}"):
        return None
    taken, _ = _numbers(spark, folder)
    if max(taken) > mine.number:             # this caller slept while others came and went
        release(spark, mine)
        return None
    for number in taken:
        if number < mine.number - 1:
            files.delete(spark, _file(folder, number))
            files.delete(spark, _file(folder, number) + ".done")
    return mine


def release(spark: SparkSession, claim: Claim) -> None:
    files.create_new(spark, _file(claim.folder, claim.number) + ".done", claim.owner)


def release_owned(spark: SparkSession, folder: str, owner: str) -> None:
    """Give back what ``owner`` holds, if it does."""
    taken, done = _numbers(spark, folder)
    last = max(taken, default=0)
    if last and last not in done and (files.read_text(spark, _file(folder, last)) or "").split("\n")[0] == owner:
        release(spark, Claim(folder, last, owner))


@contextmanager
def held(spark: SparkSession, folder: str, owner: str, lease: float = LEASE_SECONDS):
    """The claim (or None) for the time of a ``with`` block; given back in any case."""
    claim = acquire(spark, folder, owner, lease)
    try:
        yield claim
    finally:
        if claim:
            release(spark, claim)
