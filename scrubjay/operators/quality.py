"""Declarative data-quality rules evaluated as Spark aggregates (Q1-Q8, K8).

All rules of a suite are compiled into *one* global aggregate (row rules
become ``count_if`` expressions, table rules are aggregate SQL), so a suite
costs one scan with map-side partial aggregation; the one-row result is
unpivoted into one result row per rule.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from ..functions.text import nullish_in

RESULT_COLUMNS = ["scan_id", "job_id", "run_ts", "rule_name", "dimension", "column_name",
                  "description", "rule_type", "evaluated", "passed", "null_count",
                  "pass_ratio", "passed_flag"]


@dataclass(kw_only=True)
class Rule:
    name: str
    dimension: str
    description: str = ""
    column: str | None = None
    threshold: float = 1.0       # share of evaluated rows that must pass
    ignore_null: bool = False    # False: NULL counts as failing

    rule_type = "RULE"

    def _null(self, df) -> Column:
        return nullish_in(df, self.column)

    def _cond(self, df) -> Column:
        raise NotImplementedError

    def aggregates(self, df) -> tuple[Column, Column, Column]:
        """(evaluated, passed, null_count) as aggregate expressions."""
        cond = F.coalesce(self._cond(df), F.lit(False))
        if self.column is None:
            return F.count(F.lit(1)), F.count_if(cond), F.lit(None).cast("bigint")
        nul = self._null(df)
        if self.ignore_null:
            return F.count_if(~nul), F.count_if(~nul & cond), F.count_if(nul)
        return F.count(F.lit(1)), F.count_if(~nul & cond), F.count_if(nul)


@dataclass(kw_only=True)
class NonNull(Rule):
    rule_type = "NON_NULL"

    def _cond(self, df):
        return F.lit(True)

    def aggregates(self, df):
        nul = self._null(df)
        return F.count(F.lit(1)), F.count_if(~nul), F.count_if(nul)


@dataclass(kw_only=True)
class RowCondition(Rule):
    sql_expression: str
    rule_type = "ROW_CONDITION"

    def _cond(self, df):
        return F.expr(self.sql_expression)


@dataclass(kw_only=True)
class Range(Rule):
    min_value: str | None = None
    max_value: str | None = None
    strict_min: bool = False
    strict_max: bool = False
    rule_type = "RANGE"

    def _cond(self, df):
        c = F.col(f"`{self.column}`")
        dt = df.schema[self.column].dataType
        cast = (lambda v: F.lit(v).cast(dt)) if isinstance(dt, NumericType) else F.lit
        ok = F.lit(True)
        if self.min_value is not None:
            lo = cast(self.min_value)
            ok = ok & ((c > lo) if self.strict_min else (c >= lo))
        if self.max_value is not None:
            hi = cast(self.max_value)
            ok = ok & ((c < hi) if self.strict_max else (c <= hi))
        return ok


@dataclass(kw_only=True)
class TableCondition(Rule):
    """An aggregate SQL predicate over the whole table: one check, passed or
    not. An empty table passes a ``COUNT(DISTINCT k) = COUNT(*)`` rule."""
    sql_expression: str
    rule_type = "TABLE_CONDITION"

    def aggregates(self, df):
        cond = F.coalesce(F.expr(self.sql_expression), F.lit(False))
        return F.lit(1).cast("bigint"), F.when(cond, 1).otherwise(0).cast("bigint"), \
            F.lit(None).cast("bigint")


def quality_source(spark, table: str | None = None, path: str | None = None) -> DataFrame:
    """The table a suite scans, addressed by catalog name or by path."""
    if (table is None) == (path is None):
        raise ValueError("give exactly one of table= or path=")
    if table is not None:
        return spark.table(table)
    from ..sources.tables import read_table
    return read_table(spark, path)


def vehicle_rules(year_min: str = "1900", year_max: str = "2025") -> list[Rule]:
    """The listing suite."""
    # Rule names, dimensions, expressions and descriptions of the
    # listing quality suite.
    return [
        NonNull(name="cylinders-not-null", column="cylinders", dimension="COMPLETENESS",
                description="Ensure cylinders field is not null"),
        RowCondition(name="vin-length-check", column="VIN", dimension="VALIDITY",
                     sql_expression="LENGTH(VIN) = 17",
                     description="VIN must be exactly 17 characters"),
        TableCondition(name="vin-uniqueness", dimension="UNIQUENESS",
                       sql_expression="COUNT(DISTINCT VIN) = COUNT(*)",
                       description="VIN values must be unique across all records"),
        Range(name="year-range-check", column="year", dimension="VALIDITY",
              min_value=year_min, max_value=year_max,
              description=f"Year must be between {year_min} and {year_max}"),
    ]


def run_suite(df: DataFrame, rules: list[Rule], scan_id: str = "scan",
              job_id: str | None = None, run_ts: str | datetime | None = None) -> DataFrame:
    """Evaluate ``rules`` over ``df`` now (Q5, Q6); one result row per rule.

    ``run_ts`` (default: now, in UTC) and ``job_id`` (default: a new id) identify the
    run in a results table; both are fixed when the suite is built.
    """
    for r in rules:
        if r.column is not None and r.column not in df.columns:
            raise ValueError(f"rule {r.name}: column '{r.column}' not in table")
    # One scan for the whole suite. Several DISTINCT table rules in one
    # aggregate would make Spark expand every row once per distinct group;
    # then the table rules get their own aggregate instead.
    n_distinct = sum(isinstance(r, TableCondition) and "distinct" in r.sql_expression.lower()
                     for r in rules)
    split = n_distinct > 1
    groups = ([[i for i, r in enumerate(rules) if not isinstance(r, TableCondition)],
               [i for i, r in enumerate(rules) if isinstance(r, TableCondition)]]
              if split else [list(range(len(rules)))])
    one = None
    for idx in groups:
        if not idx:
            continue
        aggs = []
        for i in idx:
            ev, ps, nc = rules[i].aggregates(df)
            aggs += [ev.cast("bigint").alias(f"e{i}"), ps.cast("bigint").alias(f"p{i}"),
                     nc.cast("bigint").alias(f"n{i}")]
        part = df.agg(*aggs)
        # two one-row frames side by side: a union then max per column keeps
        # it a plain aggregate (no join of any kind)
        one = part if one is None else _side_by_side(one, part)
    # literals: an exported run and a displayed one are the same run
    when = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f") if run_ts is None else str(run_ts)
    ts = F.to_timestamp(F.lit(when))
    jid = F.lit(job_id or f"{scan_id}-{uuid.uuid4().hex}")
    rows = []
    for i, r in enumerate(rules):
        ev, ps = F.col(f"e{i}"), F.col(f"p{i}")
        raw = F.try_divide(ps.cast("double"), ev.cast("double"))
        ratio = F.round(raw, 6)
        rows.append(F.struct(
            F.lit(r.name).alias("rule_name"), F.lit(r.dimension).alias("dimension"),
            F.lit(r.column).cast("string").alias("column_name"),
            F.lit(r.description).alias("description"), F.lit(r.rule_type).alias("rule_type"),
            ev.alias("evaluated"), ps.alias("passed"), F.col(f"n{i}").alias("null_count"),
            ratio.alias("pass_ratio"),
            F.coalesce(raw >= F.lit(r.threshold), F.lit(True)).alias("passed_flag")))
    out = one.select(F.inline(F.array(*rows)))
    return out.select(F.lit(scan_id).alias("scan_id"), jid.alias("job_id"),
                      ts.alias("run_ts"), *[c for c in out.columns])


def _side_by_side(a: DataFrame, b: DataFrame) -> DataFrame:
    """Combine two one-row frames with disjoint columns into one row."""
    cols = a.columns + b.columns
    ua = a.select(*[F.col(c) if c in a.columns else F.lit(None).cast("bigint").alias(c) for c in cols])
    ub = b.select(*[F.col(c) if c in b.columns else F.lit(None).cast("bigint").alias(c) for c in cols])
    return ua.unionByName(ub).agg(*[F.max(c).alias(c) for c in cols])


def latest(results: DataFrame, scan_id: str | None = None,
           job_id: str | None = None) -> DataFrame:
    """Result rows of one run (Q7): by ``job_id`` if given, else each scan's
    latest run by ``run_ts``."""
    results = results.withColumn("job_id", F.col("job_id").cast("string"))
    r = results if scan_id is None else results.filter(F.col("scan_id") == scan_id)
    if job_id is not None:
        return r.filter(F.col("job_id") == job_id)
    last = r.groupBy(F.col("scan_id").alias("_scan")).agg(
        F.max_by("job_id", "run_ts").alias("_job"))
    return r.join(last, (F.col("scan_id") == F.col("_scan")) & (F.col("job_id") == F.col("_job")),
                  "left_semi")


def by_dimension(results: DataFrame) -> DataFrame:
    """Pass/fail per quality dimension (Q8)."""
    return results.groupBy("scan_id", "job_id", "dimension").agg(
        F.count(F.lit(1)).alias("rules"),
        F.count_if(F.col("passed_flag")).alias("rules_passed"),
        F.sum("evaluated").alias("evaluated"), F.sum("passed").alias("passed"),
        F.round(F.try_divide(F.sum("passed").cast("double"),
                             F.sum("evaluated").cast("double")), 6).alias("pass_ratio"))


def export_results(results: DataFrame, target: str, as_table: bool = False) -> None:
    """Add a run's results to a results table or folder, partitioned by ``job_id`` (K8).
    Exporting a job id again replaces its rows, so a retry leaves no duplicates."""
    spark = results.sparkSession
    known = as_table and spark.catalog.tableExists(target)
    if known or not as_table:
        # a table's folder is written as a folder is: the mode is a setting of this write alone
        cols = spark.table(target).columns if known else results.columns
        folder = spark.sql(f"DESCRIBE FORMATTED {target}").where("col_name = 'Location'").first()["data_type"] if known else target
        w = results.select(*cols).write.option("partitionOverwriteMode", "dynamic").mode("overwrite")
        w.partitionBy("job_id").parquet(folder)
        if known:
            spark.catalog.recoverPartitions(target)
            spark.catalog.refreshTable(target)
    else:
        results.write.partitionBy("job_id").format("parquet").saveAsTable(target)
