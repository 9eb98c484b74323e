"""Data-quality checks: any number of rules, one pass over the data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnwork.functions.columns import bin_index
from tarnwork.operators.drift import psi_term


@dataclass(frozen=True, kw_only=True)
class Check:
    """A rule on one column. ``severity`` is only reported."""

    column: str
    severity: str = "critical"
    name: str | None = None

    @property
    def label(self) -> str:
        return self.name or f"{self.kind}({self.column})"

    kind = "check"


@dataclass(frozen=True, kw_only=True)
class RowCheck(Check):
    """A rule every row passes or fails; at least the share ``mostly`` has to pass.

    NULL rows are skipped unless ``counts_null`` says they take part.
    """

    mostly: float = 1.0

    counts_null = False

    def __post_init__(self):
        if not 0 <= self.mostly <= 1:
            raise ValueError("mostly must lie between 0 and 1")

    def passes(self) -> Column:
        raise NotImplementedError

    def applies(self) -> Column:
        return F.lit(True) if self.counts_null else F.col(self.column).isNotNull()

    def fails(self) -> Column:
        """True for the rows that count as unexpected, never NULL."""
        return self.applies() & ~F.coalesce(self.passes(), F.lit(False))


@dataclass(frozen=True, kw_only=True)
class NotNull(RowCheck):
    """The value is not NULL."""

    kind = "not_null"
    counts_null = True

    def passes(self) -> Column:
        return F.col(self.column).isNotNull()


@dataclass(frozen=True, kw_only=True)
class GreaterThan(RowCheck):
    """The value is greater than ``bound``."""

    bound: float = 0

    kind = "greater_than"

    def __post_init__(self):
        super().__post_init__()
        if self.bound is None:
            raise ValueError("bound is required")

    def passes(self) -> Column:
        return F.col(self.column) > self.bound


@dataclass(frozen=True, kw_only=True)
class Between(RowCheck):
    """``min_value <= value <= max_value``; either bound may be left out."""

    min_value: float | None = None
    max_value: float | None = None

    kind = "between"

    def __post_init__(self):
        super().__post_init__()
        _validate_bounds(self.min_value, self.max_value)

    def passes(self) -> Column:
        return _inside(F.col(self.column), self.min_value, self.max_value, False, False)


@dataclass(frozen=True, kw_only=True)
class Equals(RowCheck):
    """The value equals ``constant``; NULL is unexpected."""

    constant: object

    kind = "equals"
    counts_null = True

    def passes(self) -> Column:
        return F.col(self.column).eqNullSafe(F.lit(self.constant))


@dataclass(frozen=True, kw_only=True)
class AggregateBetween(Check):
    """An aggregate of the column, as a number, lies between two bounds.

    Text that is no number is ignored. An aggregate over nothing fails.
    """

    min_value: float | None = None
    max_value: float | None = None
    strict_min: bool = False
    strict_max: bool = False
    aggregate: str = "mean"

    kind = "aggregate_between"

    def __post_init__(self):
        _validate_bounds(self.min_value, self.max_value)
        if not isinstance(self.strict_min, bool) or not isinstance(self.strict_max, bool):
            raise ValueError("strict_min and strict_max must be booleans")
        if self.aggregate not in ("mean", "min", "max", "sum"):
            raise ValueError(f"unknown aggregate {self.aggregate!r}")

    def observed(self) -> Column:
        return getattr(F, self.aggregate)(F.col(self.column).try_cast("double"))


@dataclass(frozen=True, kw_only=True)
class StablePopulation(Check):
    """The column's PSI between two periods is at most ``max_psi``.

    Without a limit the PSI is only reported.
    """

    period: str
    splits: Sequence[float]
    baseline: str
    current: str
    max_psi: float | None = None
    open_ended: bool = False

    kind = "stable_population"

    def bins(self) -> int:
        finite = [s for s in self.splits if s not in (float("inf"), float("-inf"))]
        return len(finite) + 1 if self.open_ended else len(self.splits) - 1


def _validate_bounds(low: float | None, high: float | None) -> None:
    if low is None and high is None:
        raise ValueError("at least one bound is required")
    for bound in (low, high):
        if bound is not None and (isinstance(bound, bool) or not isinstance(bound, (int, float))):
            raise ValueError("bounds must be numbers")
    if low is not None and high is not None and low > high:
        raise ValueError("the lower bound exceeds the upper bound")


def _inside(value: Column, low, high, strict_low: bool, strict_high: bool) -> Column:
    conditions = []
    if low is not None:
        conditions.append(value > low if strict_low else value >= low)
    if high is not None:
        conditions.append(value < high if strict_high else value <= high)
    return reduce(lambda a, b: a & b, conditions)


def _measures(i: int, check: Check) -> dict[str, Column]:
    """The aggregates a check needs, by output name."""
    if isinstance(check, RowCheck):
        return {
            f"evaluated_{i}": F.count_if(check.applies()),
            f"unexpected_{i}": F.count_if(check.fails()),
        }
    evaluated = {f"evaluated_{i}": F.count(check.column)}
    if isinstance(check, AggregateBetween):
        return {**evaluated, f"observed_{i}": check.observed()}
    if isinstance(check, StablePopulation):
        cell = F.col(f"_bin_{i}")
        period = F.col(check.period)
        return evaluated | {
            f"{side}_{i}_{b}": F.count_if((cell == b) & (period == getattr(check, side)))
            for b in range(check.bins())
            for side in ("baseline", "current")
        }
    raise TypeError(f"unknown check {check!r}")


def _psi_of(i: int, check: StablePopulation) -> Column:
    """Sum of the bins' terms, over arrays of counts: its size is linear in the bins."""

    def shares(side: str) -> Column:
        counts = F.array(*[F.col(f"{side}_{i}_{n}") for n in range(check.bins())])
        total = F.aggregate(counts, F.lit(0).cast("long"), lambda x, y: x + y)
        # The outer function binds the total, so it is added up once.
        bound = F.transform(
            F.array(total),
            lambda t: F.transform(counts, lambda n: F.coalesce(F.try_divide(n, t), F.lit(0.0))),
        )
        return F.get(bound, F.lit(0))

    terms = F.zip_with(shares("baseline"), shares("current"), lambda b, c: psi_term(b, c))
    return F.aggregate(terms, F.lit(0.0), lambda x, y: x + y)


def _result(i: int, check: Check) -> Column:
    """The result row of a check, built from its aggregates."""
    evaluated = F.col(f"evaluated_{i}")
    unexpected = F.lit(None).cast("long")
    ratio = observed = F.lit(None).cast("double")
    if isinstance(check, RowCheck):
        unexpected = F.col(f"unexpected_{i}")
        ratio = F.try_divide(evaluated - unexpected, evaluated)
        success = F.coalesce(ratio >= check.mostly, F.lit(True))
    elif isinstance(check, AggregateBetween):
        observed = F.col(f"observed_{i}").cast("double")
        inside = _inside(
            observed, check.min_value, check.max_value, check.strict_min, check.strict_max
        )
        success = F.coalesce(inside, F.lit(False))
    else:
        observed = _psi_of(i, check)
        success = F.lit(True) if check.max_psi is None else observed <= check.max_psi
    return F.struct(
        F.lit(check.label).alias("check"),
        F.lit(check.column).alias("column"),
        F.lit(check.severity).alias("severity"),
        evaluated.alias("evaluated"),
        unexpected.alias("unexpected"),
        ratio.alias("success_ratio"),
        observed.alias("observed"),
        success.alias("success"),
    )


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """All checks in a single aggregation over ``df``; one result row per check.

    Columns: check, column, severity, evaluated, unexpected, success_ratio,
    observed, success. Row checks pass when nothing was evaluated.
    """
    if not checks:
        raise ValueError("no checks given")
    bins = {
        f"_bin_{i}": bin_index(F.col(c.column), c.splits, c.open_ended)
        for i, c in enumerate(checks)
        if isinstance(c, StablePopulation)
    }
    measures: dict[str, Column] = {}
    for i, check in enumerate(checks):
        measures |= _measures(i, check)
    totals = df.withColumns(bins).agg(*[m.alias(name) for name, m in measures.items()])
    rows = F.array(*[_result(i, check) for i, check in enumerate(checks)])
    return totals.select(F.inline(rows))


def failing_rows(df: DataFrame, check: RowCheck) -> DataFrame:
    """The rows that count as unexpected under a row check."""
    return df.where(check.fails())
