"""Data-quality constraints as operators: violation report and quarantine.

Parquet tables take no CHECK, UNIQUE or FOREIGN KEY clauses, so the rules
of the star schema are checked here.  Row rules are evaluated together in
one aggregate pass; key rules are one grouped aggregate (uniqueness) or one
anti join (foreign key) each.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Rule:
    name: str
    kind: str  # 'row', 'unique', 'foreign_key'
    violated: Column | None = None  # row rules: TRUE where the row breaks it
    keys: tuple[str, ...] = ()
    ref: DataFrame | None = None
    ref_keys: tuple[str, ...] = ()


def not_null(col: str) -> Rule:
    return Rule(f"not_null({col})", "row", F.col(col).isNull())


def check(name: str, cond: Column) -> Rule:
    """CHECK semantics: a row passes when ``cond`` is TRUE or NULL."""
    return Rule(name, "row", F.coalesce(~cond, F.lit(False)))


def in_range(col: str, lo: float | None = None, hi: float | None = None) -> Rule:
    c = F.col(col)
    if lo is not None and hi is not None:
        cond, label = c.between(lo, hi), f"{col} between {lo} and {hi}"
    elif lo is not None:
        cond, label = c >= lo, f"{col} >= {lo}"
    else:
        cond, label = c <= hi, f"{col} <= {hi}"
    return check(f"check({label})", cond)


def fits_decimal(col: str, precision: int, scale: int) -> Rule:
    """A present value that does not fit NUMERIC(precision, scale)."""
    c = F.col(col)
    fitted = c.try_cast(T.DecimalType(precision, scale))
    return Rule(f"numeric({col},{precision},{scale})", "row", c.isNotNull() & fitted.isNull())


def unique(*keys: str) -> Rule:
    return Rule(f"unique({','.join(keys)})", "unique", keys=tuple(keys))


def foreign_key(keys: Sequence[str], ref: DataFrame, ref_keys: Sequence[str] | None = None) -> Rule:
    keys = tuple(keys)
    return Rule(
        f"foreign_key({','.join(keys)})", "foreign_key", keys=keys, ref=ref, ref_keys=tuple(ref_keys or keys)
    )


def constraint_report(df: DataFrame, rules: Sequence[Rule], table: str = "") -> DataFrame:
    """One row per rule: (table_name, rule, violations).

    ``unique`` counts rows beyond the first per key; ``foreign_key`` counts
    rows whose (non-NULL) key is missing from the referenced table.
    """
    spark = df.sparkSession
    parts: list[DataFrame] = []
    row_rules = [r for r in rules if r.kind == "row"]
    if row_rules:
        agg = df.agg(
            *[F.count(F.when(r.violated, F.lit(1))).alias(f"_r{i}") for i, r in enumerate(row_rules)]
        )
        parts.append(
            agg.select(
                F.explode(
                    F.array(
                        *[
                            F.struct(F.lit(r.name).alias("rule"), F.col(f"_r{i}").alias("violations"))
                            for i, r in enumerate(row_rules)
                        ]
                    )
                ).alias("_x")
            ).select("_x.rule", "_x.violations")
        )
    for r in rules:
        if r.kind == "unique":
            dup = (
                df.groupBy(*r.keys)
                .agg(F.count(F.lit(1)).alias("_n"))
                .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("violations"))
            )
            parts.append(dup.select(F.lit(r.name).alias("rule"), "violations"))
        elif r.kind == "foreign_key":
            present = _and([F.col(k).isNotNull() for k in r.keys])
            ref = r.ref.select(*[F.col(rk).alias(k) for k, rk in zip(r.keys, r.ref_keys)])
            orphans = df.where(present).join(ref, on=list(r.keys), how="left_anti")
            parts.append(
                orphans.agg(F.count(F.lit(1)).alias("violations")).select(
                    F.lit(r.name).alias("rule"), "violations"
                )
            )
    if not parts:
        return spark.createDataFrame([], "table_name string, rule string, violations bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(table).alias("table_name"), "rule", F.col("violations").cast("bigint"))


def tagged(df: DataFrame, rules: Sequence[Rule], name: str = "violations") -> DataFrame:
    """Rows with ``name``, the names of the row rules that each one breaks."""
    row_rules = [r for r in rules if r.kind == "row"]
    names = F.array_compact(
        F.array(*[F.when(r.violated, F.lit(r.name)) for r in row_rules])
    ) if row_rules else F.array().cast("array<string>")
    return df.withColumn(name, names)


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Split rows into (good, bad) by the row rules; ``bad`` carries the
    names of the rules each row breaks in ``violations``."""
    rows = tagged(df, rules, "_violations")
    good = rows.where(F.size("_violations") == 0).drop("_violations")
    bad = rows.where(F.size("_violations") > 0).withColumnRenamed("_violations", "violations")
    return good, bad


def _and(conds):
    out = F.lit(True)
    for c in conds:
        out = out & c
    return out
