"""Coverage and integrity checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityflow.functions.text import success_rate


def coverage(rows: DataFrame, has: Column) -> DataFrame:
    """(total, covered, percent)."""
    return rows.agg(F.count("*").alias("total"), F.count_if(has).alias("covered")).withColumn("percent", success_rate(F.col("covered"), F.col("total") - F.col("covered")))


def source_coverage(rows: DataFrame) -> DataFrame:
    return coverage(rows, F.array_contains("sources", F.col("item_id")))


def permission_coverage(rows: DataFrame) -> DataFrame:
    return coverage(rows, F.size("permissions") > 0)


def missing(rows: DataFrame, required: list[str]) -> DataFrame:
    """Rows that lack a required field, with the fields' names."""
    gaps = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    return rows.withColumn("missing", gaps).where(F.size("missing") > 0)


def untagged(relations: DataFrame) -> DataFrame:
    return relations.where(F.col("relationTag").isNull() | (F.size("relationTag") == 0))


def batch_totals(results: DataFrame) -> DataFrame:
    return results.agg(F.count("*").alias("documents"), F.coalesce(F.sum("entity_count"), F.lit(0)).alias("entities"), F.coalesce(F.sum("relationship_count"), F.lit(0)).alias("relationships"), F.count_if(F.col("error").isNotNull()).alias("errors"))


def batch_statistics(batches: DataFrame) -> DataFrame:
    """(file, documents, entities, merged, relations, rejected, errors) of read batches (file, item_id, entities, relations, error, merged, rejected)."""
    n = lambda c: F.coalesce(F.sum(F.greatest(F.size(c), F.lit(0))), F.lit(0)).cast("long")
    return batches.groupBy("file").agg(F.count_if(F.col("error").isNull()).alias("documents"), n("entities").alias("entities"), F.coalesce(F.sum("merged"), F.lit(0)).alias("merged"), n("relations").alias("relations"), F.coalesce(F.sum("rejected"), F.lit(0)).alias("rejected"), F.count_if(F.col("error").isNotNull()).alias("errors"))
