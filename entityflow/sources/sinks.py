"""Exports. Each writes a folder of Spark part files and returns its statistics as a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

LIGHT_FIELDS = ("id", "title", "doc_type", "timestamp")


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes below a path of any file system that Spark reaches."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(at).getLength()


def export_json(docs: DataFrame, path: str, run_at: str, include_metadata: bool = True, pretty: bool = False) -> DataFrame:
    """JSON below ``documents`` (lines, or indented objects) and one row about the export below ``metadata``: number of documents, bytes, time."""
    spark = docs.sparkSession
    out = docs if include_metadata or "metadata" not in docs.columns else docs.drop("metadata")
    if pretty:
        out = out.select(F.to_json(F.struct("*"), {"pretty": "true"}).alias("value"))
        out.write.mode("overwrite").text(f"{path}/documents", lineSep="\n\n")
        n = spark.read.text(f"{path}/documents", lineSep="\n\n").count()
    else:
        out.write.mode("overwrite").json(f"{path}/documents")
        n = spark.read.schema(out.schema).json(f"{path}/documents").count()
    stats = spark.createDataFrame([(n, size_of(spark, f"{path}/documents"), run_at, include_metadata)], "total_documents long, bytes long, exported_at string, include_metadata boolean")
    stats.write.mode("overwrite").json(f"{path}/metadata")
    return stats


def export(docs: DataFrame, path: str, kind: str = "json", run_at: str = "", **options) -> DataFrame:
    """One door to all exports: json, by_type (types, limit), light (fields) and lines. Returns what was written where: documents and bytes."""
    if kind == "json":
        return export_json(docs, path, run_at, **options)
    if kind == "by_type":
        return export_by_type(docs, options.pop("types"), path, **options)
    if kind == "light":
        export_light(docs, path, **options)
    elif kind == "lines":
        export_json_lines(docs, path)
    else:
        raise ValueError(f"no export of kind {kind}")
    spark = docs.sparkSession
    return spark.createDataFrame([(spark.read.text(path).count(), size_of(spark, path), run_at)], "total_documents long, bytes long, exported_at string")


def top_per_type(docs: DataFrame, limit: int | None, by: str = "doc_type", order: str = "id") -> DataFrame:
    if limit is None:
        return docs
    w = Window.partitionBy(by).orderBy(order)
    return docs.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= limit).drop("_r")


def export_by_type(docs: DataFrame, types: list[str], path: str, limit: int | None = None, by: str = "doc_type") -> DataFrame:
    """A folder per type; the result has every asked type with its count and status."""
    kept = top_per_type(docs.where(F.col(by).isin(types)), limit, by)
    kept.write.mode("overwrite").partitionBy(by).json(path)
    n = kept.groupBy(by).agg(F.count("*").alias("n"))
    asked = docs.sparkSession.createDataFrame([(t,) for t in types], f"{by} string")
    return asked.join(n, by, "left").select(by, F.coalesce("n", F.lit(0)).alias("n"), F.when(F.col("n") > 0, F.lit("exported")).otherwise(F.lit("no documents")).alias("status"))


def projected(docs: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """The asked fields that exist."""
    return docs.select(*[F.col(f) for f in (fields or LIGHT_FIELDS) if f in docs.columns])


def export_light(docs: DataFrame, path: str, fields: list[str] | None = None) -> None:
    projected(docs, fields).write.mode("overwrite").json(path)


def export_json_lines(docs: DataFrame, path: str) -> None:
    docs.write.mode("overwrite").json(path)


def save_results(results: DataFrame, path: str, run_id: str) -> None:
    """One folder per run."""
    results.write.mode("errorifexists").json(f"{path}/run={run_id}")
