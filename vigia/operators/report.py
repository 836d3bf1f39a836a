"""Grouped reports declared as data.

A report names its keys, its aggregates and what happens after them; :func:`run_report` turns that
into one ``groupBy().agg()``.  Aggregates are written over *state columns*, additive numbers that
every case carries (``st_cases`` is 1, ``st_deaths`` is 0 or 1, ...).  Grouping by more keys than a
report needs and summing the states yields a table with the same columns, so one report definition
runs on cases and on any :func:`rollup` of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigia.model import CASE_COLUMNS, Thresholds, Vocabulary
from vigia.operators.prefix import running_totals


def _members(column: str, values: Iterable[str]) -> str:
    quoted = ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)
    return f"CASE WHEN {column} IN ({quoted}) THEN 1 ELSE 0 END"


def state_columns(vocabulary: Vocabulary) -> dict[str, str]:
    """State column -> SQL expression over a case row."""
    return {
        "st_cases": "1",
        "st_deaths": "fallecido",
        "st_recovered": "recuperado_flag",
        "st_severe": _members("estado", vocabulary.severe),
        "st_hospital": _members("ubicacion", vocabulary.hospital),
        "st_age_sum": "edad_anios",
        "st_age_n": "CASE WHEN edad_anios IS NOT NULL THEN 1 ELSE 0 END",
        "st_density_sum": "densidad_poblacional",
        "st_density_n": "CASE WHEN densidad_poblacional IS NOT NULL THEN 1 ELSE 0 END",
        **moments("st_diagnosis", "datediff(fecha_diagnostico, fecha_inicio_sintomas)"),
        **moments("st_recovery", "CASE WHEN recuperado_flag = 1 THEN datediff(fecha_recuperacion, fecha_diagnostico) END"),
        **moments("st_death", "CASE WHEN fallecido = 1 THEN datediff(fecha_muerte, fecha_diagnostico) END"),
    }


#: Squares are summed about this many days, near the middle of what durations take.
SHIFT = 14
#: How states merge that are not added.
MERGED = {"_min": F.min, "_max": F.max}


def moments(state: str, days: str) -> dict[str, str]:
    """States of a number of days: how many, sum and sum of squares about ``SHIFT``, least and largest.

    All are whole numbers and merge without loss of digits: mean and deviation of a merged state are those of its rows.
    """
    return {
        f"{state}_n": f"CASE WHEN ({days}) IS NOT NULL THEN 1 ELSE 0 END",
        f"{state}_sum": f"CAST(({days}) - {SHIFT} AS BIGINT)",
        f"{state}_squares": f"CAST(({days}) - {SHIFT} AS BIGINT) * CAST(({days}) - {SHIFT} AS BIGINT)",
        f"{state}_min": days,
        f"{state}_max": days,
    }


def mean_of(state: str) -> str:
    """SQL for the mean of a merged state."""
    return f"try_divide(sum({state}_sum), sum({state}_n)) + {SHIFT}D"


def deviation_of(state: str) -> str:
    """SQL for the sample deviation of a merged state; NULL below two rows."""
    n, total, squares = (f"CAST(sum({state}_{part}) AS DECIMAL(19, 0))" for part in ("n", "sum", "squares"))
    return (f"sqrt(try_divide(CAST({n} * {squares} - {total} * {total} AS DOUBLE), "
            f"CAST({n} AS DOUBLE) * CAST({n} - 1 AS DOUBLE)))")


def merge(state: str) -> Column:
    """The aggregate that merges a state."""
    return MERGED.get(state[state.rfind("_"):], F.sum)(state)


@dataclass(frozen=True)
class Report:
    """A result dataset.  Texts are Spark SQL; ``{name}`` refers to a threshold.

    ``grain`` asks for a first aggregation at ``keys + grain`` that keeps the states and the
    ``carried`` columns.  It turns several distinct counts into plain counts over few rows, where
    Spark would otherwise expand every case once per distinct column.
    """

    name: str
    keys: tuple[str, ...]
    measures: Mapping[str, str]
    where: str | None = None
    grain: tuple[str, ...] = ()
    carried: Mapping[str, str] = field(default_factory=dict)
    having: str | None = None
    top: tuple[str, str, str] | None = None      # (key, measure, threshold with the number)
    derived: Mapping[str, str] = field(default_factory=dict)
    running: Mapping[str, str] = field(default_factory=dict)  # totals of measures over all keys in order
    keep: str | None = None                      # filter on measures and derived columns
    dropped: tuple[str, ...] = ()
    order: tuple[str, ...] = ()                  # "-column" sorts descending
    limit: str | None = None
    fallback: Report | None = None               # used when columns are absent
    optional: bool = False                       # absent columns give no result
    empty_schema: str | None = None              # absent columns give an empty result
    one_file: bool = True                        # CSV copy in one file: only where code lists bound the rows

    def texts(self) -> list[str]:
        texts = [*self.keys, *self.grain, *self.carried.values(), *self.measures.values()]
        return texts + [t for t in (self.where,) if t]


def mentions(texts: Iterable[str], names: Iterable[str]) -> list[str]:
    """Those of ``names`` that occur as words in the texts."""
    words = set(re.findall(r"\w+", " ".join(texts)))
    return [n for n in names if n in words]


def required_columns(report: Report, vocabulary: Vocabulary = Vocabulary()) -> list[str]:
    """Case columns a report reads, those behind its states included."""
    states = state_columns(vocabulary)
    texts = report.texts()
    texts += [states[s] for s in mentions(texts, states)]
    return mentions(texts, CASE_COLUMNS)


def with_states(df: DataFrame, vocabulary: Vocabulary, only: Iterable[str] | None = None) -> DataFrame:
    """Add the state columns whose inputs are there; a roll-up already has them."""
    wanted = state_columns(vocabulary)
    names = set(wanted if only is None else only) - set(df.columns)
    return df.withColumns({
        s: F.expr(text)
        for s, text in wanted.items()
        if s in names and set(mentions([text], CASE_COLUMNS)) <= set(df.columns)
    })


def rollup(
    df: DataFrame,
    keys: Iterable[str],
    vocabulary: Vocabulary = Vocabulary(),
    only: Iterable[str] | None = None,
    carried: Mapping[str, str] | None = None,
) -> DataFrame:
    """Merge the states by ``keys``: the same table at a coarser grain."""
    rows = with_states(df, vocabulary, only)
    states = [s for s in state_columns(vocabulary) if s in rows.columns and (only is None or s in set(only))]
    return rows.groupBy(*keys).agg(
        *[merge(s).alias(s) for s in states],
        *[F.expr(text).alias(c) for c, text in (carried or {}).items()],
    )


def _ordering(order: Iterable[str], keys: Iterable[str]) -> list:
    """Sort columns with the keys appended, so that equal measures come in a fixed order."""
    columns = [(o.lstrip("-"), o.startswith("-")) for o in order]
    columns += [(k, False) for k in keys if k not in {c for c, _ in columns}]
    return [F.col(c).desc_nulls_last() if down else F.col(c).asc_nulls_first() for c, down in columns]


def within_top(df: DataFrame, key: str, measure: str, number: int) -> DataFrame:
    """Rows of the ``number`` values of ``key`` with the largest sum of ``measure``, ties by key.

    A NULL key takes its place among them and is left out after that, as ``key IN (top keys)``
    does.  A semi join with the top keys would plan the input twice; here it is one pass, and the
    rank limit cuts the rows of each task to its own top keys before they meet in one.
    """
    total = F.sum(measure).over(Window.partitionBy(key))
    place = F.dense_rank().over(Window.orderBy(F.col("__total").desc(), F.col(key).asc_nulls_first()))
    ranked = df.withColumn("__total", total).withColumn("__place", place)
    kept = ranked.filter((F.col("__place") <= number) & F.col(key).isNotNull())
    return kept.drop("__total", "__place")


def run_report(
    df: DataFrame,
    report: Report,
    thresholds: Thresholds = Thresholds(),
    vocabulary: Vocabulary = Vocabulary(),
) -> DataFrame | None:
    """Plan a report on cases or on a roll-up of them; ``None`` if it is optional and cannot run."""
    states = mentions(report.texts(), state_columns(vocabulary))
    rows = with_states(df, vocabulary, states)
    needed = [*mentions(report.texts(), CASE_COLUMNS), *states]
    if not set(needed) <= set(rows.columns):
        if report.fallback is not None:
            return run_report(df, report.fallback, thresholds, vocabulary)
        if report.empty_schema is not None:
            return df.sparkSession.createDataFrame([], report.empty_schema)
        if report.optional:
            return None
        missing = sorted(set(needed) - set(rows.columns))
        raise ValueError(f"report {report.name} needs the columns {', '.join(missing)}")

    values = asdict(thresholds)
    if report.where:
        rows = rows.filter(report.where)
    if report.grain:
        rows = rollup(rows, (*report.keys, *report.grain), vocabulary, states, report.carried)
    measures = [F.expr(text).alias(name) for name, text in report.measures.items()]
    result = rows.groupBy(*report.keys).agg(*measures)
    if report.having:
        result = result.filter(report.having.format(**values))
    if report.top:
        key, measure, number = report.top
        result = within_top(result, key, measure, values[number])
    if report.running:
        result = running_totals(result, report.keys, report.running)
    for name, text in report.derived.items():
        result = result.withColumn(name, F.expr(text.format(**values)))
    if report.keep:
        result = result.filter(report.keep.format(**values))
    result = result.drop(*report.dropped)
    if report.order or report.limit:
        result = result.orderBy(*_ordering(report.order, report.keys))
    if report.limit:
        result = result.limit(values[report.limit])
    return result


def pivot_counts(df: DataFrame, key: str, column: str, values: Iterable[str], rest: str = "otros") -> DataFrame:
    """Cases by ``key`` with one column per listed value of ``column``; absent pairs are 0.

    The values are given, which saves the extra job that would look for them and keeps the schema
    the same for any data; other values, NULL included, are counted together in ``rest``.
    """
    values = list(values)
    rows = with_states(df, Vocabulary(), ["st_cases"]).withColumn(
        column, F.when(F.col(column).isin(values), F.col(column)).otherwise(rest))
    values = [v for v in values if v != rest] + [rest]
    return (
        rows.groupBy(key)
        .pivot(column, values)
        .agg(F.sum("st_cases"))
        .na.fill(0)
        .orderBy(F.col(key).asc_nulls_first())
    )
