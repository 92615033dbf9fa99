"""The analysis report over the two tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators import analysis


def report(post: DataFrame, engagement: DataFrame) -> dict[str, DataFrame]:
    """Every result of the report, lazily. All but the sample are a few rows."""
    lifetime = analysis.deletion_lifetime(post)
    hist = analysis.histogram(lifetime, "time_online_int_clean")
    return {
        "post_count": analysis.row_count(post),
        "post_sample": analysis.sample(post),
        "engagement_by_type": analysis.engagement_by_type(engagement),
        "deleted_posts": analysis.deleted(post),
        "deletion_lifetime": lifetime,
        "histogram": hist,
        "histogram_max": analysis.max_count(hist),
        "histogram_marks": analysis.histogram_marks(hist),
    }
