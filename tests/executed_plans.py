from __future__ import annotations


def plan_of(df) -> str:
    """The physical plan that ``df`` ran with."""
    df.toArrow()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]
