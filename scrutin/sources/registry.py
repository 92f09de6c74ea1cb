"""Which files belong to which election year, and where they are."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class YearSource:
    """File names of one year, in the order the year's reader takes them.

    ``encoding`` overrides what the caller asks for.
    """

    year: int
    files: tuple[str, ...]
    encoding: str | None = None

    def charset(self, requested: str) -> str:
        return self.encoding or requested


# Published file names.
YEAR_SOURCES = (
    YearSource(2008, ("MN08_BVot_T1T2.txt",)),
    YearSource(2014, ("MN14_Bvot_T1T2.txt",)),
    YearSource(
        2020,
        (
            "2020-05-18-resultats-par-niveau-burvot-t1-france-entiere.txt",
            "resultats-par-niveau-burvot-t2-france-entiere.txt",
        ),
    ),
    YearSource(
        2026,
        (
            "municipales-2026-resultats-bv-par-communes-2026-03-20.csv",
            "municipales-2026-resultats-bureau-de-vote-2026-03-23-16h15.csv",
        ),
        "utf-8",
    ),
)


def supported_years() -> list[int]:
    return [s.year for s in YEAR_SOURCES]


def source_of(year: int) -> YearSource:
    return next(s for s in YEAR_SOURCES if s.year == year)


def selected_years(text: str | Iterable[int]) -> list[int]:
    """Years from ``all``, a comma list or an iterable: order kept, repeats dropped."""
    known = supported_years()
    if isinstance(text, str):
        if text.strip().lower() == "all":
            return known
        tokens = [t.strip() for t in text.split(",") if t.strip()]
    else:
        tokens = [str(t) for t in text]
    if not tokens:
        raise ValueError("no year selected")
    bad = [t for t in tokens if not t.lstrip("+-").isdigit()]
    if bad:
        raise ValueError(f"not a year: {', '.join(bad)}")
    years = list(dict.fromkeys(int(t) for t in tokens))
    unknown = [y for y in years if y not in known]
    if unknown:
        raise ValueError(f"unsupported year: {unknown}; supported are {known}")
    return years


# --- file system -----------------------------------------------------------------------------


def file_system(spark: SparkSession, path: str):
    sc = spark.sparkContext
    hadoop_path = sc._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(sc._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = file_system(spark, path)
    return fs.exists(hadoop_path)


def is_directory(spark: SparkSession, path: str) -> bool:
    """True unless the path is one of the plain files the registry knows.

    A dataset written by Spark is a directory too, so the name decides before the file system.
    """
    if source_by_file(path) is not None:
        return False
    fs, hadoop_path = file_system(spark, path)
    return fs.exists(hadoop_path) and fs.getFileStatus(hadoop_path).isDirectory()


def file_name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def source_by_file(path: str) -> YearSource | None:
    name = file_name(path)
    return next((s for s in YEAR_SOURCES if name in s.files), None)


def locate(spark: SparkSession, source: YearSource, path: str) -> list[str] | None:
    """Paths of all files of a year in a folder, or next to one of its files; all or none."""
    if is_directory(spark, path):
        folder = path.rstrip("/")
    elif file_name(path) in source.files:
        folder = path.rstrip("/").rpartition("/")[0] or "."
    else:
        return None
    paths = [f"{folder}/{name}" for name in source.files]
    return paths if all(exists(spark, p) for p in paths) else None
