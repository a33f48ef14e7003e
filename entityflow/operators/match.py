"""Duplicate detection as equi-joins on blocking keys.

Every rule of a type becomes key rows (scope, type, priority, key, side). Items of
one key are linked by a star to one centre instead of by all pairs, so a key that
a third of all items share costs one edge an item; the components are the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityflow.config import FALLBACK_CONFIDENCE, Rule
from entityflow.functions.text import normalise

from .components import connected_components


def rules_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    rows = [(r.entity_type, r.kind, r.match, r.db, r.priority, r.confidence) for r in rules]
    return spark.createDataFrame(rows, "entity_type string, kind string, match string, db string, priority int, confidence double")


def blocking_keys(items: DataFrame, rules: list[Rule], strict: bool = False, scope: str | None = None) -> DataFrame:
    """(scope, entity_type, priority, confidence, kind, side, key, uid) of items (uid, entity_name, entity_type, attributes, list_keys).

    side: E for exact values; P for the searched value and L for list elements. Blank keys never match.
    strict: a scalar is no list, an alias is read only from an attribute of that name, and names only from the
    attribute; otherwise scalars stand in for lists, a name is looked for among aliases, and the entity name counts.
    Types without rules match by name.
    """
    spark = items.sparkSession
    typed = rules_table(spark, rules)
    rest = items.select("entity_type").distinct().join(F.broadcast(typed.select("entity_type").distinct()), "entity_type", "left_anti")
    base = [F.col("uid"), (F.col(scope) if scope else F.lit(0)).alias("scope"), F.col("entity_type"), F.col("entity_name"), F.col("attributes"), F.col("list_keys")]
    it = items.select(*base)
    joined = it.join(F.broadcast(typed), "entity_type").unionByName(it.join(rest, "entity_type", "left_semi").select("*", F.lit("exact").alias("kind"), F.lit("name").alias("match"), F.lit("name").alias("db"), F.lit(999).alias("priority"), F.lit(FALLBACK_CONFIDENCE).alias("confidence")).select(*it.columns, "kind", "match", "db", "priority", "confidence"))
    value = F.try_element_at("attributes", F.col("match"))
    listed = F.array_contains("list_keys", F.col("match"))
    none = F.array().cast("array<string>")
    if not strict:
        value = F.when((F.col("match") == "name") | ((F.col("match") == "alias") & value.isNull()), F.coalesce(F.try_element_at("attributes", F.lit("name")), F.array("entity_name"))).otherwise(value)
    scalar = F.when(listed, none).otherwise(value) if strict else value
    elements = F.try_element_at("attributes", F.col("db"))
    if strict:
        elements = F.when(F.array_contains("list_keys", F.col("db")), elements)
    sides = F.when(F.col("kind") == "exact", F.transform(F.coalesce(scalar, none), lambda v: F.struct(F.lit("E").alias("side"), v.alias("key")))).otherwise(F.concat(F.transform(F.coalesce(scalar, none), lambda v: F.struct(F.lit("P").alias("side"), v.alias("key"))), F.transform(F.coalesce(elements, none), lambda v: F.struct(F.lit("L").alias("side"), v.alias("key")))))
    keys = joined.select("scope", "entity_type", "priority", "confidence", "kind", "uid", F.explode(sides).alias("s"))
    return keys.select("scope", "entity_type", "priority", "confidence", "kind", F.col("s.side").alias("side"), normalise(F.col("s.key")).alias("key"), "uid").where("key <> ''").distinct()


def match_edges(keys: DataFrame, strict: bool = False) -> DataFrame:
    """(src, dst, priority, confidence): a star per key. Search keys without a list element join nothing under strict rules."""
    group = ["scope", "entity_type", "priority", "confidence", "kind", "key"]
    centre = F.min("uid") if not strict else F.when(F.first("kind") == "exact", F.min("uid")).otherwise(F.min(F.when(F.col("side") == "L", F.col("uid"))))
    heads = keys.groupBy(*group).agg(centre.alias("dst"), F.count("*").alias("n")).where("n > 1 and dst is not null")
    e = keys.join(heads, group).where(F.col("uid") != F.col("dst"))
    return e.groupBy(F.col("uid").alias("src"), "dst").agg(F.min("priority").alias("priority"), F.max_by("confidence", -F.col("priority")).alias("confidence"))


def resolve(items: DataFrame, rules: list[Rule], save: Callable[[DataFrame], DataFrame], strict: bool = False, scope: str | None = None) -> DataFrame:
    """(uid, cluster): cluster is the smallest uid of the component; items without a match are their own."""
    keys = save(blocking_keys(items, rules, strict, scope))
    labels = connected_components(match_edges(keys, strict), save)
    return items.select("uid").join(labels.select(F.col("node").alias("uid"), "component"), "uid", "left").select("uid", F.coalesce("component", "uid").alias("cluster"))


def match_stored(items: DataFrame, nodes: DataFrame, rules: list[Rule]) -> DataFrame:
    """(uid, name, priority, confidence): the stored node of each item by the first rule that hits, then by name."""
    spark = items.sparkSession
    typed = F.broadcast(rules_table(spark, rules))
    arrays = [f.name for f in nodes.schema.fields if f.dataType.simpleString() == "array<string>"]
    strings = [f.name for f in nodes.schema.fields if f.dataType.simpleString() == "string" and f.name != "type"]
    stored = F.map_from_arrays(F.array(*[F.lit(c) for c in strings + arrays]), F.array(*[F.array(F.col(c)) for c in strings], *[F.coalesce(F.col(c), F.array().cast("array<string>")) for c in arrays]))
    db = nodes.select(F.col("type").alias("entity_type"), "name", stored.alias("m")).join(typed, "entity_type").select("entity_type", "priority", "confidence", "name", F.explode(F.try_element_at("m", F.col("db"))).alias("v"))
    db = db.select("entity_type", "priority", "confidence", "name", F.lower("v").alias("key")).where("key <> ''")
    keys = blocking_keys(items, rules).where("side in ('E', 'P')").select("entity_type", "priority", "key", "uid")
    hits = keys.join(db, ["entity_type", "priority", "key"])
    return hits.groupBy("uid").agg(F.min(F.struct("priority", "name", "confidence")).alias("h")).select("uid", "h.name", "h.priority", "h.confidence")


def legacy_lookup(items: DataFrame, nodes: DataFrame) -> DataFrame:
    """(uid, name, step): the stored node of each item by its hashed id as a name (1), for persons by an e-mail among the stored ones (2), then by
    name and employer together (3); the first step that hits, then the least name."""
    from entityflow.functions.text import entity_id, json_text

    at = lambda k: F.get(F.try_element_at("attributes", F.lit(k)), F.lit(0))
    it = items.select("uid", "entity_type", at("email").alias("email"), at("name").alias("own"), at("worksAt").alias("place"), entity_id(F.col("entity_type"), at("name"), at("emails"), at("worksAt"), at("domain"), json_text(F.col("attributes"), F.col("list_keys"))).alias("id"))
    n = nodes.select(F.col("type").alias("entity_type"), "name", "emails", "worksAt")
    steps = [
        it.join(n, [it["entity_type"] == n["entity_type"], it["id"] == n["name"]]).select("uid", "name", F.lit(1).alias("step")),
        it.where("entity_type = 'Person'").join(n.where("entity_type = 'Person'").select("name", F.explode("emails").alias("email")), "email").select("uid", "name", F.lit(2).alias("step")),
        it.where("entity_type = 'Person'").join(n.where("entity_type = 'Person'").select("name", F.col("worksAt").alias("place"), F.col("name").alias("own")), ["own", "place"]).select("uid", "name", F.lit(3).alias("step")),
    ]
    hits = steps[0].unionByName(steps[1]).unionByName(steps[2])
    return hits.groupBy("uid").agg(F.min(F.struct("step", "name")).alias("h")).select("uid", "h.name", "h.step")
