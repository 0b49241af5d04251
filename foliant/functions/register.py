"""SQL names for functions that SQL bodies can express."""

from __future__ import annotations

from pyspark.sql import SparkSession

_BODIES = {
    "foliant_cosine(a ARRAY<DOUBLE>, b ARRAY<DOUBLE>) RETURNS DOUBLE": """coalesce(aggregate(zip_with(a, b, (x, y) -> x * y), 0D, (s, x) -> s + x)
        / nullif(sqrt(aggregate(a, 0D, (s, x) -> s + x * x)) * sqrt(aggregate(b, 0D, (s, x) -> s + x * x)), 0D), 0D)""",
    "foliant_estimated_tokens(t STRING) RETURNS INT": "greatest(1, (length(t) + 3) div 4)",
    "foliant_suffix(label STRING) RETURNS STRING": "array_join(transform(regexp_extract_all(regexp_replace(lower(trim(label)), '^[*]?[0-9]*', ''), '[a-z]+', 0), p -> concat('(', p, ')')), '')",
    "foliant_collapse(t STRING) RETURNS STRING": r"trim(regexp_replace(t, '(?U)\\s+', ' '))",
}


def register(spark: SparkSession) -> list[str]:
    """Create the functions for this session; their names."""
    for head, body in _BODIES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
    return [h.split("(")[0] for h in _BODIES]
