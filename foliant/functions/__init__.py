"""Column builders; register(spark) names some of them as SQL functions."""
