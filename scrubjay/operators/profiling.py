"""Column profiles (A10-A14): each is one global aggregate over the table,
unpivoted into one row per column with ``inline``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import NumericType

from ..functions.keys import is_valid_key
from ..functions.text import nullish_in, pct

KEY_LENGTH = 17


_nullish = nullish_in


def _drawn(df: DataFrame, fraction: float, key: str | None, seed: int):
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must be between 0 and 1")
    of = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")) if key else F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), of)), 1, 8), 16, 10).cast("bigint")
    return drawn < F.lit(int(fraction * (1 << 32)))


def profile_sample(df: DataFrame, fraction: float = 0.1, key: str | None = None, seed: int = 42) -> DataFrame:
    """A sample for quick profiles (S10): the rows whose ``key`` (default: all columns) hashes below a threshold. The same
    rows come out whatever the input split or order, a larger fraction holds the smaller one's rows, and two tables
    sampled by one key keep matching rows. A null key counts as ''."""
    return df.filter(_drawn(df, fraction, key, seed))


def sampled_nulls(df: DataFrame, key: str, cols: list[str], fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """``column_name, sample_rows, sample_nulls, est_rows, est_nulls, est_nulls_error``: counts scaled up from ``profile_sample``, and
    the standard error of the scaled null count. Keys are drawn independently, so the variance is (1 - f) / f^2 times the sum
    over drawn keys of the squared number of their null rows; keys may hold several rows."""
    sample = profile_sample(df, fraction, key, seed)
    keys = sample.groupBy(F.col(f"`{key}`").alias("_k")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(_nullish(sample, c)).alias(f"_c{i}") for i, c in enumerate(cols)])
    one = keys.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_n"), *[
        x for i in range(len(cols)) for x in (F.coalesce(F.sum(f"_c{i}"), F.lit(0)).alias(f"_s{i}"),
                                              F.coalesce(F.sum(F.col(f"_c{i}") * F.col(f"_c{i}")), F.lit(0)).alias(f"_q{i}"))])
    scaled = lambda c: F.round(F.col(c) / F.lit(fraction), 4)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col("_n").alias("sample_rows"), F.col(f"_s{i}").alias("sample_nulls"),
                     scaled("_n").alias("est_rows"), scaled(f"_s{i}").alias("est_nulls"),
                     F.round(F.sqrt(F.col(f"_q{i}") * F.lit((1 - fraction) / fraction ** 2)), 4).alias("est_nulls_error"))
            for i, c in enumerate(cols)]
    return one.select(F.inline(F.array(*rows)))


def sketch_columns(df: DataFrame, by: list[str], distinct: list[str], numeric: list[str], lg_k: int = 14, kll_k: int = 400) -> DataFrame:
    """Profiles that can be stored and added up (A12, A13): a row for each value of ``by`` (a day, a file) with ``n_rows``, a
    HyperLogLog sketch of every ``distinct`` column and, of every ``numeric`` one, a quantile (KLL) sketch, ``n``, ``min``, ``max``, ``sum`` and
    ``sum_sq``. Missing values and NaN are left out. One pass, a fixed size a group."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in distinct:
        aggs.append(F.hll_sketch_agg(F.when(~_nullish(df, c), F.col(f"`{c}`").cast("string")), F.lit(lg_k)).alias(f"{c}__hll"))
    for c in numeric:
        v = F.when(~_nullish(df, c), F.col(f"`{c}`")).cast("double")
        aggs += [F.kll_sketch_agg_double(v, F.lit(kll_k)).alias(f"{c}__kll"), F.count(v).alias(f"{c}__n"), F.min(v).alias(f"{c}__min"), F.max(v).alias(f"{c}__max"),
                 F.sum(v).alias(f"{c}__sum"), F.sum(v * v).alias(f"{c}__sum_sq")]
    return df.groupBy(*by).agg(*aggs)


def sketch_profile(sketches: DataFrame, distinct: list[str], numeric: list[str], shares: tuple[float, ...] = (0.5,), lg_k: int = 14) -> DataFrame:
    """``column_name, n, n_distinct, min_value, max_value, avg_value`` and a ``q`` column a share, from any rows of
    stored ``sketch_columns``, without reading the table again. Distinct counts are within about 2% with the default
    ``lg_k``, ranks of quantiles within about 1%; the rest is exact."""
    aggs = [F.hll_sketch_estimate(F.hll_union_agg(f"{c}__hll")).alias(f"{c}__d") for c in distinct]
    for c in numeric:
        aggs += [F.kll_merge_agg_double(f"{c}__kll").alias(f"{c}__kll"), F.sum(f"{c}__n").alias(f"{c}__n"), F.min(f"{c}__min").alias(f"{c}__min"),
                 F.max(f"{c}__max").alias(f"{c}__max"), F.sum(f"{c}__sum").alias(f"{c}__sum")]
    one = sketches.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), *aggs)
    none = lambda t: F.lit(None).cast(t)
    names = [f"q{s:g}" for s in shares]
    rows = []
    for c in dict.fromkeys([*distinct, *numeric]):
        number, has = c in numeric, F.col(f"{c}__n") > 0 if c in numeric else None
        rows.append(F.struct(
            F.lit(c).alias("column_name"), (F.col(f"{c}__n") if number else none("bigint")).alias("n"),
            (F.col(f"{c}__d") if c in distinct else none("bigint")).alias("n_distinct"),
            (F.col(f"{c}__min") if number else none("double")).alias("min_value"), (F.col(f"{c}__max") if number else none("double")).alias("max_value"),
            (F.try_divide(F.col(f"{c}__sum"), F.col(f"{c}__n").cast("double")) if number else none("double")).alias("avg_value"),
            *[(F.when(has, F.kll_sketch_get_quantile_double(F.col(f"{c}__kll"), F.lit(s))) if number else none("double")).alias(q) for s, q in zip(shares, names)]))
    return one.select(F.inline(F.array(*rows)))


def footer_profile(spark: SparkSession, path: str, cols: list[str]) -> DataFrame:
    """``column_name, n_rows, n_present, min_value, max_value`` (as text) of a Parquet table from its footers (A9, A10, A13): the aggregation
    is pushed into the reader, so no column is read. Whole numbers, dates and booleans only: footers of floating
    columns leave NaN out, and those of texts may be cut. A session of its own holds the settings this needs."""
    session = spark.newSession()
    session.conf.set("spark.sql.sources.useV1SourceList", "")
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    df = session.read.parquet(path)
    allowed = ("tinyint", "smallint", "int", "bigint", "date", "boolean")
    wrong = [c for c, t in df.select(*cols).dtypes if t not in allowed]
    if wrong:
        raise ValueError(f"footers are no exact source for {wrong}")
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[x for i, c in enumerate(cols) for x in (
        F.count(F.col(f"`{c}`")).alias(f"_p{i}"), F.min(F.col(f"`{c}`")).alias(f"_l{i}"), F.max(F.col(f"`{c}`")).alias(f"_h{i}"))])
    text = lambda c: F.col(c).cast("string")
    return one.select(F.inline(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col("_n").alias("n_rows"), F.col(f"_p{i}").alias("n_present"), text(f"_l{i}").alias("min_value"), text(f"_h{i}").alias("max_value"))
        for i, c in enumerate(cols)])))


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``column_name, null_count, null_pct`` for every column."""
    cols = cols or df.columns
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(_nullish(df, c)).alias(f"_c{i}") for i, c in enumerate(cols)])
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"_c{i}").alias("null_count"),
                     pct(F.col(f"_c{i}"), F.col("_n"), 4).alias("null_pct"))
            for i, c in enumerate(cols)]
    return one.select(F.inline(F.array(*rows)))


def key_profile(df: DataFrame, key: str = "VIN") -> DataFrame:
    """Key integrity (A11): rows with a raw length of 17, rows passing full
    validation, and rows missing or of the wrong length."""
    k = F.col(key)
    a = df.agg(F.count(F.lit(1)).alias("total_rows"),
               F.count_if(F.length(k) == KEY_LENGTH).alias("len17_rows"),
               F.count_if(is_valid_key(k)).alias("valid_rows"),
               F.count_if(k.isNull()).alias("null_rows"))
    bad = F.col("total_rows") - F.col("len17_rows")
    return a.select("total_rows", "len17_rows", "valid_rows", "null_rows",
                    bad.alias("missing_or_invalid_rows"),
                    pct("len17_rows", "total_rows", 4).alias("len17_pct"),
                    pct(bad, "total_rows", 4).alias("missing_or_invalid_pct"))


def cardinality(df: DataFrame, cols: list[str], approx: bool = False,
                rsd: float = 0.02, table_name: str | None = None) -> DataFrame:
    """Distinct values per column (A12). Exact by default; ``approx=True``
    uses HyperLogLog++ (one pass, fixed memory) for huge tables."""
    fn = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.count_distinct
    one = df.agg(*[fn(F.col(f"`{c}`")).alias(f"_d{i}") for i, c in enumerate(cols)])
    rows = [F.struct(F.lit(table_name).cast("string").alias("table_name"),
                     F.lit(c).alias("column_name"), F.col(f"_d{i}").cast("bigint").alias("n_distinct"))
            for i, c in enumerate(cols)]
    return one.select(F.inline(F.array(*rows)))


def numeric_profile(df: DataFrame, cols: list[str] | None = None,
                    table_name: str | None = None, digits: int = 6) -> DataFrame:
    """``n, min, max, avg, stddev`` (sample) per numeric column (A13); NaN is
    treated as missing so averages stay finite."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    aggs = []
    for i, c in enumerate(cols):
        v = F.when(~_nullish(df, c), F.col(f"`{c}`")).cast("double")
        aggs += [F.count(v).alias(f"_n{i}"), F.min(v).alias(f"_mi{i}"), F.max(v).alias(f"_ma{i}"),
                 F.avg(v).alias(f"_av{i}"), F.stddev_samp(v).alias(f"_sd{i}")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(table_name).cast("string").alias("table_name"), F.lit(c).alias("column_name"),
                     F.col(f"_n{i}").alias("n"),
                     F.round(f"_mi{i}", digits).alias("min_value"),
                     F.round(f"_ma{i}", digits).alias("max_value"),
                     F.round(f"_av{i}", digits).alias("avg_value"),
                     F.round(f"_sd{i}", digits).alias("stddev_value"))
            for i, c in enumerate(cols)]
    return one.select(F.inline(F.array(*rows)))


def validity_profile(df: DataFrame, checks: list[tuple[str, str, float]]) -> DataFrame:
    """Outlier evidence (A14): for each ``(column, op, threshold)`` with ``op``
    in ``>``, ``>=``, ``<``, ``<=``: the column's min/max and how many rows
    cross the threshold."""
    ops = {">": lambda c, t: c > t, ">=": lambda c, t: c >= t,
           "<": lambda c, t: c < t, "<=": lambda c, t: c <= t}
    aggs = []
    for i, (c, op, t) in enumerate(checks):
        col = F.col(f"`{c}`").cast("double")
        aggs += [F.min(col).alias(f"_mi{i}"), F.max(col).alias(f"_ma{i}"),
                 F.count_if(ops[op](col, F.lit(float(t)))).alias(f"_f{i}")]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(f"{c} {op} {t:g}").alias("check_name"), F.lit(c).alias("column_name"),
                     F.col(f"_mi{i}").alias("min_value"), F.col(f"_ma{i}").alias("max_value"),
                     F.lit(float(t)).alias("threshold"), F.col(f"_f{i}").alias("n_flagged"))
            for i, (c, op, t) in enumerate(checks)]
    return one.select(F.inline(F.array(*rows)))
