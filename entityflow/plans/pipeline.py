"""Documents to graph: extract, parse, resolve, merge, commit."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entityflow.config import Config
from entityflow.functions import extract, parse
from entityflow.functions.embed import Embedder, embed
from entityflow.functions.text import entity_text
from entityflow.operators import match, merge, quality, relations
from entityflow.schema import GraphStore
from entityflow.sources import documents as sources


def saver(spark: SparkSession, base: str):
    """Cut lineage through written tables below the base path; ``clean`` deletes them."""
    paths: list[str] = []

    def save(df: DataFrame) -> DataFrame:
        path = f"{base}/_work/{uuid.uuid4().hex}"
        df.write.parquet(path)
        paths.append(path)
        return spark.read.schema(df.schema).parquet(path)

    def clean() -> None:
        for p in paths:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)

    save.clean = clean
    return save


def extracted(docs: DataFrame, extractor: extract.Extractor | None = None) -> DataFrame:
    """Documents (id, text or content, source, optional permissions) to parsed results; a plug-in replaces the rule-based default."""
    text = "text" if "text" in docs.columns else "content"
    d = docs.select(F.col("id").cast("string").alias("item_id"), F.col(text).alias("text"), F.coalesce("source", F.lit("unknown")).alias("source"))
    raw = extract.extract_with(d, extractor) if extractor else extract.extract_rules(d)
    out = parse.parsed(raw)
    if "permissions" in docs.columns:
        out = relations.attach_permissions(out, docs.select(F.col("id").cast("string").alias("item_id"), "permissions"))
    return out


def items_of(results: DataFrame) -> DataFrame:
    """Entity rows with a unique id whose order is (document, place); permissions of the document become an attribute."""
    return numbered(parse.entity_items(results))


def numbered(items: DataFrame) -> DataFrame:
    if "permissions" in items.columns:
        there = F.size("permissions") > 0
        rest = F.map_filter("attributes", lambda k, v: k != "permissions")
        items = items.withColumns({"attributes": F.when(there, F.map_concat(rest, F.create_map(F.lit("permissions"), F.col("permissions")))).otherwise(F.col("attributes")), "list_keys": F.when(there, F.array_union("list_keys", F.array(F.lit("permissions")))).otherwise(F.col("list_keys"))}).drop("permissions")
    return items.withColumn("uid", F.concat_ws("#", "item_id", F.lpad(F.col("batch_id").cast("string"), 8, "0"))).withColumn("ord", F.col("uid"))


def build(items: DataFrame, rels: DataFrame, stored: DataFrame, config: Config, save) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(new nodes, relations between them, rejected relations, items with their clusters). Stored nodes take part as items that come first, so their names win."""
    arrays = [f.name for f in stored.schema.fields if f.dataType.simpleString() == "array<string>"]
    strings = [f.name for f in stored.schema.fields if f.dataType.simpleString() == "string" and f.name not in ("type", "name", "lastUpdated")]
    pairs = [F.struct(F.lit(c).alias("k"), F.array(F.col(c)).alias("v")) for c in strings] + [F.struct(F.lit(c).alias("k"), F.coalesce(F.col(c), F.array().cast("array<string>")).alias("v")) for c in arrays]
    known = F.filter(F.array(*pairs), lambda p: (F.size(p["v"]) > 0) & F.get(p["v"], F.lit(0)).isNotNull())
    old = stored.select(F.lit(None).cast("string").alias("item_id"), F.lit(-1).alias("batch_id"), F.col("name").alias("entity_name"), F.col("type").alias("entity_type"), F.map_from_entries(known).alias("attributes"), F.array(*[F.lit(c) for c in arrays]).alias("list_keys"), F.concat(F.lit(" "), F.col("type"), F.lit("/"), F.col("name")).alias("uid")).withColumn("ord", F.col("uid"))
    both = save(items.unionByName(old))
    clusters = match.resolve(both, config.rules, save)
    tagged = save(both.join(clusters, "uid"))
    nodes = save(merge.clusters_to_nodes(tagged, config))
    mapping = relations.alias_map(tagged.where("item_id is not null"), nodes.select("cluster", "type", "name"))
    good, bad = relations.with_endpoints(rels, mapping)
    return nodes.drop("cluster"), good, bad, tagged


def merge_into(store: GraphStore, items: DataFrame, rels: DataFrame, now: Column, save, embedder: Embedder | None = None) -> tuple[DataFrame, DataFrame]:
    """Resolve items against the store, merge nodes and relations with new embeddings, commit both tables at once; returns the rejected
    relations and the items that joined an earlier item or a stored node."""
    nodes, good, bad, tagged = build(items, rels, store.read("nodes"), store.config, save)
    text = entity_text(F.col("type"), F.col("name"), F.col("rawDescriptions"), title=F.col("title"), role=F.array_join("role", ", "))
    # several clusters may end under one name: they are one node of the table
    once = nodes.groupBy("type", "name").agg(*[(F.array_distinct(F.flatten(F.collect_list(c))) if c in store.config.all_arrays() else F.first(c, ignorenulls=True)).alias(c) for c in nodes.columns if c not in ("type", "name")])
    store.commit(
        nodes=merge.upsert_nodes(store.read("nodes"), once.withColumn("embedding", embed(text, embedder)), store.config, now),
        relations=relations.consolidate_into(store.read("relations"), good, embedder, now),
    )
    return bad, tagged.where("item_id is not null and uid <> cluster")


def ingest(spark: SparkSession, docs: DataFrame, store: GraphStore, now: Column, extractor: extract.Extractor | None = None, embedder: Embedder | None = None) -> DataFrame:
    """Merge documents into the store; returns a status row per document. Scratch tables go at the end."""
    store.create()
    save = saver(spark, store.base)
    try:
        results = save(extracted(docs, extractor))
        good = results.where("error is null")
        merge_into(store, items_of(good), parse.relation_items(good), now, save, embedder)
        status = results.select("item_id", F.when(F.col("error").isNull(), F.lit("processed")).otherwise(F.lit("failed")).alias("status"), "entity_count", "relationship_count", "error")
        return store.keep_status(status)
    finally:
        save.clean()


def merge_files(spark: SparkSession, path: str, store: GraphStore, now: Column, pattern: str = "*.json", embedder: Embedder | None = None) -> DataFrame:
    """Merge extraction batches of a file or folder into the store; returns a row per file: documents, entities, those that joined others, relations, rejected relations, errors.

    A file that is neither layout counts as an error and changes nothing.
    """
    store.create()
    save = saver(spark, store.base)
    try:
        batches = save(sources.read_batches(spark, path, pattern))
        items, rels = numbered(sources.batch_entities(batches)), sources.batch_relations(batches)
        bad, joined = merge_into(store, items, rels, now, save, embedder)
        each = bad.select("item_id", F.lit(1).alias("rejected"), F.lit(0).alias("merged")).unionByName(joined.select("item_id", F.lit(0).alias("rejected"), F.lit(1).alias("merged")))
        counts = each.groupBy("item_id").agg(F.sum("rejected").alias("rejected"), F.sum("merged").alias("merged"))
        return store.keep_status(quality.batch_statistics(batches.join(counts, "item_id", "left")))
    finally:
        save.clean()
