"""Wide to long, driven by a mapping table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrutin.functions.numbers import localised_double
from scrutin.operators.project import quoted_name


@dataclass(frozen=True)
class MappedColumn:
    """Where one source column goes: target table, metric and period."""

    source: str
    table: str
    metric: str
    numeric: bool
    period: int


def file_safe(table: str) -> str:
    """Table name without path separators."""
    return table.replace("/", "_").replace("\\", "_")


def by_table(mapping: Iterable[MappedColumn]) -> dict[str, list[MappedColumn]]:
    """Mapping rows per target table (tables in name order), checked for contradictions."""
    tables: dict[str, list[MappedColumn]] = {}
    for row in mapping:
        tables.setdefault(row.table, []).append(row)
    for table, rows in tables.items():
        cells, kinds = set(), {}
        for row in rows:
            for cell in (("metric", row.period, row.metric), ("source", row.period, row.source)):
                if cell in cells:
                    raise ValueError(f"{table}: {cell[0]} {cell[2]} is mapped twice in {cell[1]}")
                cells.add(cell)
            if kinds.setdefault(row.metric, row.numeric) != row.numeric:
                raise ValueError(f"{table}: {row.metric} is numeric in one period only")
    names = [file_safe(t) for t in tables]
    if len(set(names)) < len(names):
        raise ValueError("two target tables share one file-safe name")
    return dict(sorted(tables.items()))


def _cell(row: MappedColumn | None, numeric: bool) -> Column:
    if row is None:
        return F.lit(None).cast("double" if numeric else "string")
    raw = F.col(quoted_name(row.source))
    return localised_double(raw) if numeric else raw.cast("string")


def wide_to_long(
    df: DataFrame, key: str, period: str, rows: Sequence[MappedColumn], carried: Sequence[str] = ()
) -> DataFrame:
    """One row per key and period, one column per metric, from a single pass over ``df``; ``carried`` columns go along.

    Metrics are ordered by first appearance in the mapping; a metric that a period lacks is null.
    """
    metrics = {r.metric: r.numeric for r in rows}
    cells = {(r.period, r.metric): r for r in rows}
    structs = [
        F.struct(
            F.lit(p).cast("bigint").alias(period),
            *[_cell(cells.get((p, m)), numeric).alias(m) for m, numeric in metrics.items()],
        )
        for p in sorted({r.period for r in rows})
    ]
    return df.select(F.col(quoted_name(key)).alias(key), *carried, F.inline(F.array(*structs)))
