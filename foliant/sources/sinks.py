"""Sinks: deterministic JSON, partitioned layout, packages of tables with key checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.operators import gates


def canonical_json(df: DataFrame, columns: list[str]) -> Column:
    """A JSON text with fields in the given order, nulls left out, times in ISO form."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "true",
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSS]XXX"})


def write_json(df: DataFrame, path: str, columns: list[str], key: str) -> None:
    """One text line for each row, in order of key."""
    df.select(key,
        canonical_json(df,
        columns).alias("value")).repartitionByRange(key).sortWithinPartitions(key).select("value").write.mode("overwrite").text(path)


def write_layout(df: DataFrame, path: str, by: list[str]) -> None:
    """Parquet below folders named by the columns."""
    df.write.mode("overwrite").partitionBy(*by).parquet(path)


def write_package(tables: dict[str, DataFrame], path: str, keys: dict[str, list[str]],
        references: list[tuple[str, list[str], str]]) -> DataFrame:
    """Write the tables if every key is unique and every reference is met; the findings (empty if written).

    references are (table, columns, referred table), columns named as the referred table's key.
    """
    first = next(iter(tables.values()))
    found = []
    for t, k in keys.items():
        found.append(gates.findings(gates.repeated_keys(tables[t], k), F.concat_ws("/", *k), f"repeated:{t}", "fail",
            F.col("count")))
    for t, cols, of in references:
        found.append(gates.findings(gates.dangling(tables[t], cols, tables[of]), F.concat_ws("/", *cols),
            f"dangling:{t}:{of}", "fail", F.lit(of)))
    out = gates.all_findings(found) if found else first.sparkSession.createDataFrame([],
        "subject string, check_id string, severity string, detail string")
    if out.isEmpty():
        for t, df in tables.items():
            df.write.mode("overwrite").parquet(f"{path}/{t}")
    return out


def read_package(spark: SparkSession, path: str, tables: list[str]) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{path}/{t}") for t in tables}


def same_package(a: dict[str, DataFrame], b: dict[str, DataFrame]) -> list[str]:
    """Tables that differ."""
    return [t for t in a if t not in b or not gates.same_rows(a[t], b[t])] + [t for t in b if t not in a]
