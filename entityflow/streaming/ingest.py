"""Incremental ingestion: progress table, resumable batches and Structured Streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entityflow.functions.text import success_rate
from entityflow.plans.pipeline import ingest
from entityflow.schema import GraphStore
from entityflow.sources.sinks import save_results

PROGRESS = "item_id string, status string, at string, session_id string, entity_count int, relationship_count int, error string"


class Progress:
    """An append-only table of statuses; the latest row of an id counts. A processed id stays processed."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def log(self) -> DataFrame:
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            return self.spark.createDataFrame([], PROGRESS)
        return self.spark.read.schema(PROGRESS).parquet(self.path)

    def append(self, rows: DataFrame) -> None:
        rows.select(*[F.col(c.split()[0]) for c in PROGRESS.split(", ")]).write.mode("append").parquet(self.path)

    def latest(self) -> DataFrame:
        return latest_status(self.log())

    def unprocessed(self, docs: DataFrame, key: str = "id") -> DataFrame:
        return unprocessed(docs, self.latest(), key)

    def sessions(self) -> DataFrame:
        """(session_id, started, ended, processed, failed, entities, relationships) of every session, in order."""
        done, lost = F.count_if(F.col("status") == "processed"), F.count_if(F.col("status") == "failed")
        return self.log().where("status <> 'reset'").groupBy("session_id").agg(F.min("at").alias("started"), F.max("at").alias("ended"), done.alias("processed"), lost.alias("failed"), F.coalesce(F.sum("entity_count"), F.lit(0)).alias("entities"), F.coalesce(F.sum("relationship_count"), F.lit(0)).alias("relationships")).orderBy("started", "session_id")

    def summary(self) -> DataFrame:
        s = self.latest().agg(F.count_if(F.col("status") == "processed").alias("processed"), F.count_if(F.col("status") == "failed").alias("failed"), F.coalesce(F.sum("entity_count"), F.lit(0)).alias("entities"), F.coalesce(F.sum("relationship_count"), F.lit(0)).alias("relationships"))
        return s.withColumn("success_rate", success_rate(F.col("processed"), F.col("failed")))

    def reset_failed(self, at: str) -> None:
        """Failed ids become new ones."""
        self.append(self.latest().where("status = 'failed'").withColumns({"status": F.lit("reset"), "at": F.lit(at)}))


def unprocessed(docs: DataFrame, latest: DataFrame, key: str = "id") -> DataFrame:
    """Documents with an id that is not processed yet; failed ones count as not processed."""
    done = latest.where("status = 'processed'").select(F.col("item_id").alias(key))
    return docs.where(F.col(key).isNotNull() & (F.col(key).cast("string") != "")).join(done, key, "left_anti")


def latest_status(log: DataFrame, key: str = "item_id", at: str = "at") -> DataFrame:
    """Latest row per id; a processed row beats later failures. One aggregate, so no window holds an id's history."""
    rank = F.struct((F.col("status") == "processed").cast("int"), F.col(at), F.col("status"))
    rest = [c for c in log.columns if c != key]
    return log.groupBy(key).agg(F.max_by(F.struct(*rest), rank).alias("r")).select(key, "r.*").where("status <> 'reset'")


def process(spark: SparkSession, docs: DataFrame, store: GraphStore, progress: Progress, session_id: str, now: Column) -> DataFrame:
    """One batch: skip processed ids, ingest, commit the graph, then the progress (so a failure in between repeats the batch)."""
    fresh = progress.unprocessed(docs)
    status = ingest(spark, fresh, store, now)
    progress.append(status.withColumns({"at": now.cast("string"), "session_id": F.lit(session_id)}))
    return status


def run(spark: SparkSession, docs: DataFrame, store: GraphStore, progress: Progress, session_id: str, now: Column, max_documents: int | None = None, results: str | None = None) -> DataFrame:
    """One session over a table of documents: at most ``max_documents`` of those that are not processed; returns the session's row.

    ``results``: a folder that gets the statuses as JSON, one folder a session.
    """
    fresh = progress.unprocessed(docs)
    status = process(spark, fresh.orderBy("id").limit(max_documents) if max_documents is not None else fresh, store, progress, session_id, now)
    if results:
        save_results(status, results, session_id)
    return progress.sessions().where(F.col("session_id") == session_id)


def stream(spark: SparkSession, docs: DataFrame, store: GraphStore, progress: Progress, checkpoint: str, now: Column, available_now: bool = True):
    """``docs`` is a streaming DataFrame; the merge is idempotent, so at-least-once delivery is enough."""
    def batch(df: DataFrame, number: int) -> None:
        process(spark, df, store, progress, f"batch-{number}", now)

    writer = docs.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
