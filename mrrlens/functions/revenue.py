"""Revenue rules as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tenure labels (with an en dash) and their inclusive upper bounds.
TENURE_BUCKETS = (("0–30", 30), ("31–90", 90), ("91–180", 180), ("181–365", 365))
LONGEST_TENURE = "365+"


def tenure_bucket(days: Column) -> Column:
    label = F.when(days.isNull(), F.lit(None).cast("string"))
    for name, upper in TENURE_BUCKETS:
        label = label.when(days <= upper, F.lit(name))
    return label.otherwise(F.lit(LONGEST_TENURE))


def is_revenue_churn(mrr: Column, prior: Column) -> Column:
    return F.coalesce((prior > 0) & (mrr == 0), F.lit(False))


def movement_class(mrr: Column, prior: Column) -> Column:
    """How an account's revenue moved since last month. At most one arm holds, so their order is free."""
    had_revenue = prior > 0
    return (
        F.when(had_revenue & (mrr == 0), "churned")
        .when(had_revenue & (mrr > prior), "expansion")
        .when(had_revenue & (mrr > 0) & (mrr < prior), "contraction")
        .when((prior == 0) & (mrr > 0), "new")
        .otherwise("none")
    )


def movement_amounts(movement: Column, mrr: Column, prior: Column) -> dict[str, Column]:
    """One amount per class, zero unless the row is of that class.

    Contraction is signed (below zero) and churned is the revenue lost (above
    zero), so mrr - prior = new + expansion + contraction - churned.
    """
    amounts = {
        "new_mrr": ("new", mrr),
        "expansion_mrr": ("expansion", mrr - prior),
        "contraction_mrr": ("contraction", mrr - prior),
        "churned_mrr": ("churned", prior),
    }
    return {
        name: F.when(movement == kind, amount).otherwise(F.lit(0).cast("bigint"))
        for name, (kind, amount) in amounts.items()
    }


def share(part: Column, whole: Column) -> Column:
    """part / whole as a double; null where there is nothing to divide by."""
    return F.try_divide(part.cast("double"), whole.cast("double"))
