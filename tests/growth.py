"""How many rows the steps of a plan give, as Spark counts them."""

from __future__ import annotations

from pyspark.sql import DataFrame


def _steps(plan):
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from _steps(plan.executedPlan())
    elif kind.endswith("QueryStageExec"):
        yield from _steps(plan.plan())
    else:
        rows = plan.metrics().get("numOutputRows")
        if rows.isDefined():
            yield int(rows.get().value())
        for i in range(plan.children().size()):
            yield from _steps(plan.children().apply(i))


def most_rows(df: DataFrame) -> int:
    """The most rows that any step gives while the table is collected."""
    df.collect()
    return max(_steps(df._jdf.queryExecution().executedPlan()))
