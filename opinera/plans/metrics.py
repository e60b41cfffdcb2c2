"""Metric reports as data: keys, measures and derived ratios, compiled to one aggregate.

A measure is kept as states that merge: counts, sums, minima and maxima. A report over a snapshot, one over live rows and
the merge of both are the same specification, finished once at the end; so an average of a merged report is the average
over all rows, whichever part they came from. Sums are doubles, as in Spark's own averages, and NaN stays NaN. Distinct
counts don't merge from counts and are kept as sets when a report is to be merged; they are for values of which a key
has few (types, not ids).
"""

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class State:
    name: str
    value: Callable[[], Column]
    how: str  # sum, min, max or set

    def first(self) -> Column:
        return {"sum": F.sum, "min": F.min, "max": F.max, "set": F.collect_set}[self.how](self.value()).alias(self.name)

    def again(self) -> Column:
        if self.how == "set":
            return F.array_distinct(F.flatten(F.collect_list(self.name))).alias(self.name)
        return {"sum": F.sum, "min": F.min, "max": F.max}[self.how](self.name).alias(self.name)


@dataclass(frozen=True)
class Measure:
    name: str
    states: tuple[State, ...]
    finish: Callable[[], Column]


def count_if(name: str, condition: Callable[[], Column]) -> Measure:
    state = State(f"_{name}", lambda: F.when(condition(), F.lit(1)).otherwise(F.lit(0)).cast("long"), "sum")
    return Measure(name, (state,), lambda: F.col(f"_{name}"))


def count_rows(name: str) -> Measure:
    return count_if(name, lambda: F.lit(True))


def average(name: str, value: Callable[[], Column], observed: str | None = None) -> tuple[Measure, ...]:
    """Over rows where value isn't null; observed names their count, if it is to be shown."""
    total = State(f"_{name}_sum", lambda: value().cast("double"), "sum")
    seen = State(f"_{name}_n", lambda: F.when(value().isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("long"), "sum")
    mean = Measure(name, (total, seen), lambda: F.try_divide(F.col(f"_{name}_sum"), F.col(f"_{name}_n").cast("double")))
    return (mean, Measure(observed, (seen,), lambda: F.col(f"_{name}_n"))) if observed else (mean,)


def extreme(name: str, value: Callable[[], Column], how: str) -> Measure:
    return Measure(name, (State(f"_{name}", value, how),), lambda: F.col(f"_{name}"))


def distinct(name: str, value: Callable[[], Column]) -> Measure:
    return Measure(name, (State(f"_{name}", value, "set"),), lambda: F.size(f"_{name}").cast("long"))


def ratio(name: str, above: str, below: str) -> Measure:
    """Of two other measures; null where the lower is zero."""
    return Measure(name, (), lambda: F.try_divide(F.col(f"_{above}").cast("double"), F.col(f"_{below}").cast("double")))


@dataclass(frozen=True)
class Report:
    keys: tuple[str, ...]
    measures: tuple[Measure, ...] = field(default_factory=tuple)

    def _states(self) -> list[State]:
        return list({s.name: s for m in self.measures for s in m.states}.values())

    def partial(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(*(s.first() for s in self._states()))

    def merge(self, parts: Sequence[DataFrame]) -> DataFrame:
        """Partial states of the union of the parts' rows; null keys are a group, as in a grouping."""
        return reduce(DataFrame.unionByName, parts).groupBy(*self.keys).agg(*(s.again() for s in self._states()))

    def finish(self, states: DataFrame) -> DataFrame:
        return states.select(*self.keys, *(m.finish().alias(m.name) for m in self.measures))

    def over(self, rows: DataFrame) -> DataFrame:
        return self.finish(self.partial(rows))


def approval(keys: Sequence[str], liked: Callable[[], Column], *more: Measure, names: tuple[str, str, str, str] = ("review_count", "positive_reviews", "negative_reviews", "recommendation_rate")) -> Report:
    """Rows, those for and against, and the share for. Null opinions count as rows only."""
    rows, yes, no, share = names
    basic = (count_rows(rows), count_if(yes, liked), count_if(no, lambda: ~liked()), ratio(share, yes, rows))
    return Report(tuple(keys), (*basic, *more))


def merged_with_provenance(report: Report, batch: DataFrame, live: DataFrame, rows: str = "review_count") -> DataFrame:
    """The merged report with how many rows each side brought, from partial states; merging is exact for averages too."""
    sides = [part.withColumns({f"_{s}": F.col(f"_{rows}") if s == side else F.lit(0).cast("long") for s in ("batch", "stream")}) for side, part in (("batch", batch), ("stream", live))]
    extra = (Measure(f"batch_{rows}", (State("_batch", lambda: F.col("_batch"), "sum"),), lambda: F.col("_batch")), Measure(f"stream_{rows}", (State("_stream", lambda: F.col("_stream"), "sum"),), lambda: F.col("_stream")))
    whole = Report(report.keys, (*report.measures, *extra))
    source = F.when(F.col(f"stream_{rows}") == 0, F.lit("batch")).when(F.col(f"batch_{rows}") == 0, F.lit("streaming")).otherwise(F.lit("batch_plus_streaming"))
    return whole.finish(whole.merge(sides)).withColumn("data_source", source)
