"""One commit for several marts: numbered manifests that name the current run of each.

A folder of marts holds ``<mart>/runs/<run>`` and ``manifests/<number>.json``.
The manifest with the highest number is the folder's state: every mart it names,
at the run it names. A refresh writes its runs first and then publishes one
manifest, so readers see all its marts change at once, or none.

A number is claimed by a rename that never replaces a file, so of two writers
one gets the number and the other builds its manifest anew on top of it. Local
folders and HDFS rename that way; a store that does not needs a table target
(see :func:`kpimart.sources.io.write_mart`).
"""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

TRIES = 100


@dataclass(frozen=True)
class Manifest:
    """``marts``: name -> {"run": .., "rows": ..}."""

    number: int
    marts: Mapping[str, Mapping[str, object]]


def _place(spark: SparkSession, path: str):
    """(file system, path) of Hadoop's API for ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _entries(spark: SparkSession, folder: str) -> dict[str, dt.datetime]:
    """Names in a folder and when they last changed; nothing if there is no such folder."""
    fs, p = _place(spark, folder)
    if not fs.exists(p):
        return {}
    return {s.getPath().getName(): dt.datetime.fromtimestamp(s.getModificationTime() / 1000, dt.timezone.utc) for s in fs.listStatus(p)}


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _place(spark, path)
    fs.delete(p, True)


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    names = _entries(spark, f"{folder}/manifests")
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read_manifest(spark: SparkSession, folder: str, number: int | None = None) -> Manifest:
    """The folder's current manifest, or an earlier one by its number; number 0 and no marts before the first commit."""
    numbers = _numbers(spark, folder)
    if number is None:
        number = numbers[-1] if numbers else 0
    elif number not in numbers:
        raise ValueError(f"{folder}: no manifest {number}")
    if number == 0:
        return Manifest(0, {})
    text = spark.read.text(f"{folder}/manifests/{number:012d}.json", wholetext=True).first()[0]
    return Manifest(number, json.loads(text)["marts"])


def _claim(spark: SparkSession, folder: str, number: int, text: str) -> bool:
    """Publish ``text`` under ``number`` unless the number is taken."""
    fs, draft = _place(spark, f"{folder}/manifests/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    _, final = _place(spark, f"{folder}/manifests/{number:012d}.json")
    try:
        if fs.getUri().getScheme() != "file":
            return not fs.exists(final) and fs.rename(draft, final)
        try:  # rename replaces files on local disks, link does not
            os.link(draft.toUri().getPath(), final.toUri().getPath())
        except FileExistsError:
            return False
        return True
    finally:
        fs.delete(draft, False)


def commit_runs(spark: SparkSession, folder: str, runs: Mapping[str, Mapping[str, object]]) -> Manifest:
    """Make ``runs`` current, all at once; marts of the folder that are not among them stay as they are."""
    for _ in range(TRIES):
        last = read_manifest(spark, folder)
        new = Manifest(last.number + 1, {**last.marts, **runs})
        if _claim(spark, folder, new.number, json.dumps({"number": new.number, "marts": new.marts}, sort_keys=True)):
            return new
    raise RuntimeError(f"{folder}: another writer was faster {TRIES} times")


def expire_runs(spark: SparkSession, folder: str, keep: int = 2, older_than: dt.timedelta = dt.timedelta(days=1)) -> list[str]:
    """Remove manifests before the last ``keep`` and the runs that no manifest left names.

    A run that no manifest ever named may be one that is being written: it goes
    once it is ``older_than``, which should exceed the longest refresh. Readers
    that hold an expired run lose it. Returns the removed runs as
    ``<mart>/<run>``.
    """
    if keep < 1:
        raise ValueError("the current manifest stays")
    numbers = _numbers(spark, folder)
    named = {n: {(m, r["run"]) for m, r in read_manifest(spark, folder, n).marts.items()} for n in numbers}
    used = set().union(*(named[n] for n in numbers[-keep:]))
    over = set().union(*(named[n] for n in numbers[:-keep])) - used
    for n in numbers[:-keep]:
        remove(spark, f"{folder}/manifests/{n:012d}.json")
    removed, before = [], dt.datetime.now(dt.timezone.utc) - older_than
    for mart in _entries(spark, folder):
        for run, changed in _entries(spark, f"{folder}/{mart}/runs").items():
            if (mart, run) in over or ((mart, run) not in used and changed < before):
                remove(spark, f"{folder}/{mart}/runs/{run}")
                removed.append(f"{mart}/{run}")
    return sorted(removed)
