"""Parquet datasets by period whose periods are replaced all at once or not at all.

A write puts its periods into a folder of its own; nothing that can be read points there. Only when all files are
complete, a new manifest says for every period which folder holds it. A job that dies before leaves the dataset
as it was, on file systems and on object stores. A manifest is one small file under the next number, created only
if nobody else has taken that number, so of two writers at once one fails instead of undoing the other.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrutin.sources.registry import file_system

MANIFESTS = "_manifests"
_DIGITS = 12


class Conflict(RuntimeError):
    """Another job has replaced periods of the dataset in the meantime."""


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, path = file_system(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def _read(spark: SparkSession, path: str) -> dict | None:
    """A manifest, or None if its file is not complete."""
    fs, where = file_system(spark, path)
    stream = fs.open(where)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return json.loads(text)
    except ValueError:
        return None


def current(spark: SparkSession, uri: str) -> tuple[int, dict[str, str]]:
    """The number of the newest complete manifest (0: none), and the folder of each period's folder name."""
    for name in reversed(_names(spark, f"{uri}/{MANIFESTS}")):
        if name.endswith(".json") and (found := _read(spark, f"{uri}/{MANIFESTS}/{name}")) is not None:
            return int(name.removesuffix(".json")), found["periods"]
    return 0, {}


def _publish(spark: SparkSession, uri: str, number: int, periods: dict[str, str]) -> None:
    taken = {int(n.removesuffix(".json")) for n in _names(spark, f"{uri}/{MANIFESTS}") if n.endswith(".json")}
    # Incomplete manifests of dead jobs keep their numbers.
    number = max([number, *taken]) + 1
    fs, path = file_system(spark, f"{uri}/{MANIFESTS}/{number:0{_DIGITS}d}.json")
    try:
        stream = fs.create(path, False)
    except Exception as taken_by_other:
        raise Conflict(f"{uri}: manifest {number} exists already") from taken_by_other
    try:
        stream.write(bytearray(json.dumps({"periods": periods}, sort_keys=True).encode()))
    finally:
        stream.close()


def write_periods(df: DataFrame, uri: str, period: str = "annee_election") -> None:
    """Replace the periods that ``df`` holds; all others stay as they are.

    The rebalance hint gathers a period into few files and still splits a large one. A table without rows replaces
    nothing.
    """
    spark, uri, folder = df.sparkSession, uri.rstrip("/"), f"data-{uuid.uuid4().hex}"
    number, periods = current(spark, uri)
    df.hint("rebalance", period).write.partitionBy(period).parquet(f"{uri}/{folder}")
    new = [n for n in _names(spark, f"{uri}/{folder}") if n.startswith(f"{period}=")]
    if not new:
        return
    if current(spark, uri)[0] != number:
        raise Conflict(f"{uri}: periods have been replaced since manifest {number}")
    _publish(spark, uri, number, {**periods, **dict.fromkeys(new, folder)})


def read_periods(spark: SparkSession, uri: str, period: str, periods: Sequence | None = None) -> DataFrame:
    """The dataset as its newest manifest has it; only folders of the selected periods are read."""
    uri = uri.rstrip("/")
    known = current(spark, uri)[1]
    if not known:
        raise FileNotFoundError(f"{uri} has no complete manifest")
    by_folder: dict[str, list[str]] = {}
    for name, folder in known.items():
        by_folder.setdefault(folder, []).append(name)
    out = None
    # As many folders as writes that are still visible, of at most one per period.
    for folder, names in sorted(by_folder.items()):
        base = f"{uri}/{folder}"
        part = spark.read.option("basePath", base).parquet(*[f"{base}/{n}" for n in sorted(names)])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out if periods is None else out.filter(F.col(period).isin(*periods))


def drop_unused(spark: SparkSession, uri: str) -> list[str]:
    """Delete data folders that the newest manifest does not name, and older manifests. No write may be under way."""
    uri = uri.rstrip("/")
    number, periods = current(spark, uri)
    held = set(periods.values())
    gone = [n for n in _names(spark, uri) if n.startswith("data-") and n not in held] if number else []
    old = [n for n in _names(spark, f"{uri}/{MANIFESTS}") if n.endswith(".json") and int(n.removesuffix(".json")) != number]
    for path in [*(f"{uri}/{n}" for n in gone), *(f"{uri}/{MANIFESTS}/{n}" for n in (old if number else []))]:
        fs, where = file_system(spark, path)
        fs.delete(where, True)
    return gone
