"""Data quality: column checks, table audits, two-build parity, tie discovery."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import exprs as X


def checks(df: DataFrame, not_null: Sequence[str] = (), unique: Sequence[str] = (), accepted: Mapping[str, Sequence] | None = None) -> DataFrame:
    """(check_name, column_name, failures, passed), all from one pass over df."""
    aggs = {}
    for c in not_null:
        aggs["not_null", c] = F.count_if(F.col(c).isNull())
    for c in unique:
        aggs["unique", c] = F.count(c) - F.count_distinct(c)
    for c, values in (accepted or {}).items():
        aggs["accepted_values", c] = F.count_if(F.col(c).isNotNull() & ~F.col(c).isin(list(values)))
    one = df.agg(*[a.alias(f"a{k}") for k, a in enumerate(aggs.values())])
    rows = F.explode(F.array(*[F.struct(F.lit(kind).alias("check_name"), F.lit(c).alias("column_name"), F.col(f"a{k}").alias("failures")) for k, (kind, c) in enumerate(aggs)]))
    return one.select(rows.alias("r")).select("r.*").withColumn("passed", F.col("failures") == 0)


def invalid_vins(df: DataFrame, vin: str, nullable: bool = False) -> DataFrame:
    """Rows that break the VIN rule; nulls break it too unless nullable."""
    bad = X.clean_vin(vin).isNull() | (F.col(vin) != F.upper(vin))
    return df.filter(bad & F.col(vin).isNotNull()) if nullable else df.filter(bad | F.col(vin).isNull())


def table_audit(df: DataFrame, grain: Sequence[str], ts: str | None = None, nulls: Sequence[str] = (), durations: Sequence[str] = ()) -> DataFrame:
    """One row: rows, distinct grain, duplicate groups, null counts, time range, negative durations."""
    groups = df.groupBy(*grain).agg(F.count("*").alias("__n"), *[F.count_if(F.col(c).isNull()).alias(f"__null_{c}") for c in nulls], *[F.count_if(F.col(c) < 0).alias(f"__neg_{c}") for c in durations], *([F.min(ts).alias("__lo"), F.max(ts).alias("__hi")] if ts else []))
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0))
    aggs = [zero("__n").alias("rows"), F.count("*").alias("distinct_grain"), F.count_if(F.col("__n") > 1).alias("duplicate_groups")]
    aggs += [zero(f"__null_{c}").alias(f"null_{c}") for c in nulls] + [zero(f"__neg_{c}").alias(f"negative_{c}") for c in durations]
    return groups.agg(*aggs, *([F.min("__lo").alias("min_ts"), F.max("__hi").alias("max_ts")] if ts else []))


def distribution(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("rows"))


def grain_specs(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """(table_name, rows, distinct_grain, duplicate_groups, holds) of each table's declared grain."""
    out = None
    for name, (df, grain) in tables.items():
        one = table_audit(df, grain).select(F.lit(name).alias("table_name"), "rows", "distinct_grain", "duplicate_groups", ((F.col("duplicate_groups") == 0) & (F.col("rows") > 0)).alias("holds"))
        out = one if out is None else out.unionByName(one)
    return out


def row_parity(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys whose rows differ: missing on a side, or with the columns that aren't equal, nulls equal."""
    both = sorted((set(a.columns) & set(b.columns)) - set(key))
    x = a.select(*[F.col(k).alias(f"k{i}") for i, k in enumerate(key)], F.struct(*both).alias("a"), F.lit(1).alias("in_a"))
    y = b.select(*[F.col(k).alias(f"j{i}") for i, k in enumerate(key)], F.struct(*both).alias("b"), F.lit(1).alias("in_b"))
    met = x.join(y, [F.col(f"k{i}").eqNullSafe(F.col(f"j{i}")) for i in range(len(key))], "full_outer")
    different = F.filter(F.array(*[F.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), F.lit(c)) for c in both]).cast("array<string>"), lambda c: c.isNotNull())
    where = F.when(F.col("in_b").isNull(), "only_a").when(F.col("in_a").isNull(), "only_b").when(F.size(different) > 0, "differs")
    out = met.withColumn("parity", where).filter("parity is not null")
    return out.select(*[F.coalesce(f"k{i}", f"j{i}").alias(k) for i, k in enumerate(key)], "parity", F.when(F.col("parity") == "differs", different).alias("columns"))


def build_parity(a: DataFrame, b: DataFrame, key: Sequence[str], ts: str | None = None) -> DataFrame:
    """(check_name, a, b, passed) of two builds of a table. Empty builds fail; nothing is tolerated."""
    shared = [c for c in a.columns if c in b.columns]

    def facts(df: DataFrame) -> DataFrame:
        audit = table_audit(df, key, ts, [c for c in shared if c not in key])
        return audit.select(F.posexplode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in audit.columns])).alias("n", "f")).select("f.*")

    x, y = facts(a).withColumnRenamed("value", "a"), facts(b).withColumnRenamed("value", "b")
    out = x.join(y, "name", "full_outer").select(F.col("name").alias("check_name"), "a", "b", F.col("a").eqNullSafe(F.col("b")).alias("passed"))
    out = out.withColumn("passed", F.when(F.col("check_name") == "rows", F.col("passed") & (F.col("a") != "0")).when(F.col("check_name") == "duplicate_groups", (F.col("a") == "0") & (F.col("b") == "0")).otherwise(F.col("passed")))
    columns = a.sparkSession.createDataFrame([("columns", ",".join(sorted(a.columns)), ",".join(sorted(b.columns)), sorted(a.columns) == sorted(b.columns))], "check_name string, a string, b string, passed boolean")
    rows = row_parity(a, b, key).agg(F.count("*").cast("string").alias("n")).select(F.lit("different_rows").alias("check_name"), F.col("n").alias("a"), F.col("n").alias("b"), (F.col("n") == "0").alias("passed"))
    return out.unionByName(columns).unionByName(rows)


def ties(df: DataFrame, key: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Keys whose greatest order is shared by more than one value: where an arg-max is open."""
    top = df.groupBy(*key).agg(F.max(F.struct(*order)).alias("__t"))
    named = top.select(*[F.col(k).alias(f"__{k}") for k in key], "__t")
    at = df.join(named, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in key] + [F.struct(*order) == F.col("__t")], "left_semi")
    return at.groupBy(*key).agg(F.count_distinct(value).alias("tied_values")).filter("tied_values > 1")


def reconcile(old: DataFrame, new: DataFrame, by: str) -> DataFrame:
    """Row counts of an old and a new layout side by side."""
    x = old.groupBy(by).agg(F.count("*").alias("old_rows"))
    y = new.groupBy(F.col(by).alias("__by")).agg(F.count("*").alias("new_rows"))
    out = x.join(y, F.col(by).eqNullSafe(F.col("__by")), "full_outer")
    a, b = F.coalesce("old_rows", F.lit(0)), F.coalesce("new_rows", F.lit(0))
    return out.select(F.coalesce(by, "__by").alias(by), a.alias("old_rows"), b.alias("new_rows"), (b - a).alias("difference"))


def coverage(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of non-null values of each column, in percent."""
    one = df.agg(F.count("*").alias("n"), *[F.count(c).alias(f"c{k}") for k, c in enumerate(columns)])
    parts: list[Column] = [F.struct(F.lit(c).alias("column_name"), F.col(f"c{k}").alias("present"), X.percent(f"c{k}", "n").alias("coverage_pct")) for k, c in enumerate(columns)]
    return one.select(F.explode(F.array(*parts)).alias("r")).select("r.*")
