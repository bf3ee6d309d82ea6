"""Data-quality rules over a table, one outcome row per rule.

Rules are Python objects. ``evaluate`` turns a rule list into aggregations
over the frame:

* all rules that need only counts share one global aggregation;
* rules on a column that need its distinct values (distinct count, primary
  key) share one two-level aggregation per column: group by the column
  (partial counts per task, so a value that holds a third of all rows costs
  one row per task), then one global pass over the groups. This avoids the
  row-multiplying Expand that several ``countDistinct`` in one aggregation
  would add.

The per-rule rows are unioned; nothing is collected to the driver.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapmart.functions import datekey

PASSED, FAILED = "Passed", "Failed"


@dataclass(frozen=True)
class Rule:
    column: str | None = None

    kind = "Rule"
    needs_distinct = False

    def text(self) -> str:
        raise NotImplementedError

    def expected(self) -> float | None:
        return None

    def actual(self, m) -> Column:
        """Measured value from the metric columns ``total``, ``nonnull``,
        ``distinct`` (distinct non-null values) and ``columns``."""
        raise NotImplementedError

    def passed(self, m) -> Column:
        raise NotImplementedError

    def reason(self) -> str:
        raise NotImplementedError


@dataclass(frozen=True)
class ColumnCount(Rule):
    value: int = 0
    kind = "ColumnCount"

    def text(self):
        return f"ColumnCount = {self.value}"

    def expected(self):
        return float(self.value)

    def actual(self, m):
        return m["columns"].cast("double")

    def passed(self, m):
        return m["columns"] == F.lit(self.value)

    def reason(self):
        return "column count does not match"


@dataclass(frozen=True)
class Completeness(Rule):
    value: float = 1.0
    kind = "Completeness"

    def text(self):
        return f'Completeness "{self.column}" = {self.value:g}'

    def expected(self):
        return float(self.value)

    def actual(self, m):
        return m["nonnull"].cast("double") / F.nullif(m["total"], F.lit(0))

    def passed(self, m):
        return F.coalesce(self.actual(m) == F.lit(float(self.value)), F.lit(False))

    def reason(self):
        return "share of non-null values does not match"


@dataclass(frozen=True)
class DistinctValuesCount(Rule):
    value: int = 0
    kind = "DistinctValuesCount"
    needs_distinct = True

    def text(self):
        return f'DistinctValuesCount "{self.column}" = {self.value}'

    def expected(self):
        return float(self.value)

    def actual(self, m):
        return m["distinct"].cast("double")

    def passed(self, m):
        return m["distinct"] == F.lit(self.value)

    def reason(self):
        return "number of distinct values does not match"


@dataclass(frozen=True)
class IsComplete(Rule):
    kind = "IsComplete"

    def text(self):
        return f'IsComplete "{self.column}"'

    def actual(self, m):
        return m["nonnull"].cast("double") / F.nullif(m["total"], F.lit(0))

    def passed(self, m):
        return m["nonnull"] == m["total"]

    def reason(self):
        return "column has null values"


@dataclass(frozen=True)
class IsPrimaryKey(Rule):
    kind = "IsPrimaryKey"
    needs_distinct = True

    def text(self):
        return f'IsPrimaryKey "{self.column}"'

    def actual(self, m):
        return m["distinct"].cast("double") / F.nullif(m["total"], F.lit(0))

    def passed(self, m):
        return (m["nonnull"] == m["total"]) & (m["distinct"] == m["total"])

    def reason(self):
        return "column has null or repeated values"


def _outcome_struct(rule: Rule, m) -> Column:
    ok = F.coalesce(rule.passed(m), F.lit(False))
    return F.struct(
        F.lit(rule.text()).alias("rule"), F.lit(rule.kind).alias("rule_type"),
        F.lit(rule.column).cast("string").alias("column"),
        F.lit(rule.expected()).cast("double").alias("expected"),
        rule.actual(m).cast("double").alias("actual"),
        F.when(ok, F.lit(PASSED)).otherwise(F.lit(FAILED)).alias("outcome"),
        F.when(ok, F.lit(None).cast("string")).otherwise(F.lit(rule.reason())).alias("failure_reason"),
    )


def _rows(agg: DataFrame, rules: list[Rule], metrics) -> DataFrame:
    return agg.select(F.inline(F.array(*[_outcome_struct(r, metrics(r)) for r in rules])))


def evaluate(df: DataFrame, rules: list[Rule], as_of: dt.date | None = None) -> DataFrame:
    """Outcome rows ``rule, rule_type, column, expected, actual, outcome,
    failure_reason`` (+ ``updated_at``, ``datekey`` when ``as_of`` is given)."""
    if not rules:
        raise ValueError("no rules to evaluate")
    ncols = len(df.columns)
    parts = []
    # a column whose values are grouped anyway gets all its counts from there
    grouped = sorted({r.column for r in rules if r.needs_distinct})
    plain = [r for r in rules if r.column not in grouped and (r.column or not grouped)]
    if plain:
        cols = sorted({r.column for r in plain if r.column})
        agg = df.agg(F.count(F.lit(1)).alias("_total"),
                     *[F.count(F.col(c)).alias(f"_nn_{i}") for i, c in enumerate(cols)])
        idx = {c: i for i, c in enumerate(cols)}

        def plain_metrics(r):
            return {"total": F.col("_total"), "columns": F.lit(ncols),
                    "nonnull": F.col(f"_nn_{idx[r.column]}") if r.column else None}
        parts.append(_rows(agg, plain, plain_metrics))
    for c in grouped:
        mine = [r for r in rules if r.column == c or r.column is None and c == grouped[0]]
        per_value = df.groupBy(F.col(c).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
        agg = per_value.agg(F.sum("_n").alias("_total"),
                            F.sum(F.when(F.col("_v").isNotNull(), F.col("_n"))).alias("_nonnull"),
                            F.count("_v").alias("_distinct"))
        metrics = {"total": F.coalesce(F.col("_total"), F.lit(0)),
                   "nonnull": F.coalesce(F.col("_nonnull"), F.lit(0)),
                   "distinct": F.col("_distinct"), "columns": F.lit(ncols)}
        parts.append(_rows(agg, mine, lambda r, m=metrics: m))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if as_of is not None:
        out = stamp(out, as_of)
    return out


def stamp(outcomes: DataFrame, as_of: dt.date) -> DataFrame:
    """Add the run day and its key to outcome rows."""
    d = F.lit(as_of).cast("date")
    return outcomes.withColumns({"updated_at": d, "datekey": datekey(d)})


def write_outcomes(outcomes: DataFrame, path: str) -> None:
    """Snappy Parquet partitioned by ``updated_at``; a rerun replaces its day."""
    (outcomes.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", "snappy").partitionBy("updated_at").parquet(path))


# The two rule sets of the original quality jobs.
CHANNEL_RULES = [
    ColumnCount(value=10),
    Completeness("channel_id", 1.0),
    DistinctValuesCount("channel_id", 5),
    IsComplete("published_date"),
    IsPrimaryKey("channel_id"),
]

VIDEO_RULES = [
    ColumnCount(value=20),
    Completeness("channel_id", 1.0),
    Completeness("video_id", 1.0),
    DistinctValuesCount("channel_id", 5),
    IsComplete("published_date"),
    IsPrimaryKey("video_id"),
]
