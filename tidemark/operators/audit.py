"""Table constraints checked as data: required columns and a unique key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def audit_constraints(df: DataFrame, key: Sequence[str], required: Sequence[str]) -> DataFrame:
    """Violations per constraint: ``check_name, violations``.

    ``not_null(c)`` counts nulls; ``unique(k)`` counts the rows beyond the first of each key.
    """
    key_value = F.struct(*[F.col(k) for k in key])
    counted = {f"not_null({c})": F.count_if(F.col(c).isNull()) for c in required}
    counted[f"unique({','.join(key)})"] = F.count(F.lit(1)) - F.count_distinct(key_value)
    rows = [
        F.struct(F.lit(name).alias("check_name"), value.alias("violations"))
        for name, value in counted.items()
    ]
    return df.agg(F.array(*rows).alias("rows")).selectExpr("inline(rows)")
