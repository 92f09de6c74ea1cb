"""Row counts of the steps of a job, taken in the passes that the job makes anyway."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

REPORT = "part string, step string, rows_in bigint, rows_out bigint, removed bigint"


@dataclass
class _Step:
    part: str
    step: str
    rows_in: list[Observation] = field(default_factory=list)
    rows_out: list[Observation] = field(default_factory=list)


def _observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    point = Observation()
    return df.observe(point, F.count(F.lit(1)).alias("rows")), point


def _total(points: list[Observation]) -> int | None:
    return sum(p.get["rows"] for p in points) if points else None


@dataclass
class Counts:
    """Collects ``rows_in`` and ``rows_out`` of named steps.

    A counted frame must be computed once, by a write say: the first action gives its counts. Nothing that samples
    its input (an ``orderBy``, say) may stand above it in the same action, as the sample would count too. A task that is
    run again because an executor was lost after it had ended counts again, so counts are exact unless that happens.
    """

    steps: list[_Step] = field(default_factory=list)

    def through(self, df: DataFrame, part: str, step: str, run: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``run`` on ``df``, with the rows before and after it counted."""
        before, first = _observed(df)
        after, last = _observed(run(before))
        self.steps.append(_Step(part, step, [first], [last]))
        return after

    def arriving(self, df: DataFrame, part: str, step: str) -> DataFrame:
        """Count the rows that go into a step whose result is counted by ``leaving``; several inputs add up."""
        out, point = _observed(df)
        self._step(part, step).rows_in.append(point)
        return out

    def leaving(self, df: DataFrame, part: str, step: str) -> DataFrame:
        out, point = _observed(df)
        self._step(part, step).rows_out.append(point)
        return out

    def _step(self, part: str, step: str) -> _Step:
        for known in self.steps:
            if (known.part, known.step) == (part, step):
                return known
        self.steps.append(_Step(part, step))
        return self.steps[-1]

    def report(self, spark: SparkSession) -> DataFrame:
        """``(part, step, rows_in, rows_out, removed)``, one row per step in the order of the steps.

        Waits for the first action on each counted frame, so call it after the job has written its result.
        """
        rows = []
        for s in self.steps:
            before, after = _total(s.rows_in), _total(s.rows_out)
            rows.append((s.part, s.step, before, after, None if before is None or after is None else before - after))
        return spark.createDataFrame(rows, REPORT)


def counted(
    counts: Counts | None, df: DataFrame, part: str, step: str, run: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """``run`` on ``df``, counted if there are ``counts``."""
    return run(df) if counts is None else counts.through(df, part, step, run)
