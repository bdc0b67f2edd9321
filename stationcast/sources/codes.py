"""Code table for delivery type, order type and region (P4-P6), encoded by a join instead of dictionaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Codes of the published report.
DELIVER_CODES = [("Self", "2"), ("FBP", "0"), ("3rd", "1")]
ORDER_CODES = [("Fresh2", "5"), ("Fresh1", "4"), ("Direct", "3"), ("Normal", "2"), ("Frozen", "1"), ("DeepFrozen", "0")]
REGION_CODES = [("North", "1"), ("South", "2"), ("East", "3"), ("Northwest", "4"), ("Southwest", "5"),
                ("Middle", "6"), ("Northeast", "7")]
# The base-class names as the source tables spell them ("self-operated", "normal").
DELIVER_ALIASES = [("自营", "2")]
ORDER_ALIASES = [("普通", "2")]

FIXED = {"deliver": DELIVER_CODES + DELIVER_ALIASES, "ord": ORDER_CODES + ORDER_ALIASES, "region": REGION_CODES}


def _values_sql(rows) -> str:
    def q(v):
        return "'" + str(v).replace("'", "''") + "'"
    return ", ".join(f"({q(k)}, {q(a)}, {q(c)})" for k, a, c in rows)


def code_dim(spark: SparkSession, extra: DataFrame | None = None) -> DataFrame:
    """``(kind, alias, code)`` rows; ``extra`` adds rows of the same schema (e.g. region names of a dataset).

    The fixed rows are an inline ``VALUES`` relation (planned on the driver, no scan).
    """
    rows = [(kind, a, c) for kind, pairs in FIXED.items() for a, c in pairs]
    dim = spark.sql(f"SELECT * FROM VALUES {_values_sql(rows)} AS t(kind, alias, code)")
    return dim.unionByName(extra) if extra is not None else dim


def fixed_code(kind: str, col: Column) -> Column:
    """Code of a fixed name as a literal-map lookup (no join); NULL when unknown."""
    m = F.create_map(*[F.lit(x) for a, c in FIXED[kind] for x in (a, c)])
    return F.try_element_at(m, col)


def encode(df: DataFrame, codes: DataFrame | None, kind: str, col: str, out: str) -> DataFrame:
    """Add ``out`` = code of ``df[col]``; NULL for an unknown name (see ``quarantined``).

    Fixed names resolve through a literal map. Names that only the dataset knows (``codes`` rows beyond the
    fixed ones, e.g. a region table) are joined, one row per alias (the least code); the planner chooses how from
    the measured size.
    """
    code = fixed_code(kind, F.col(col))
    if codes is None:
        return df.withColumn(out, code)
    fixed = spark_fixed_aliases(kind)
    lookup = (codes.where((F.col("kind") == kind) & ~F.col("alias").isin(*fixed))
              .groupBy(F.col("alias").alias("_alias")).agg(F.min("code").alias("_code")))
    joined = df.join(lookup, df[col] == lookup["_alias"], "left")
    return joined.withColumn(out, F.coalesce(code, F.col("_code"))).drop("_alias", "_code")


def spark_fixed_aliases(kind: str) -> list[str]:
    return [a for a, _ in FIXED[kind]]


def quarantined(df: DataFrame, code_cols: list[str]) -> Column:
    """True for a row whose names did not all resolve to a code."""
    cond = F.lit(False)
    for c in code_cols:
        cond = cond | F.col(c).isNull()
    return cond
