"""Attribute merging, upserts and deletes on nodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityflow.config import APPEND, BETTER, PRESERVE, REPLACE, Config
from entityflow.functions.text import append_unique


def falsy(c: Column, array: bool = False) -> Column:
    return c.isNull() | (F.size(c) == 0) if array else c.isNull() | (c.cast("string") == "")


def merged(old: Column, new: Column, strategy: str, array: bool = False) -> Column:
    """One field under a strategy; an agent-only field keeps its old value."""
    if strategy == PRESERVE:
        return F.when(falsy(old, array), new).otherwise(old)
    if strategy == APPEND:
        if array:
            return append_unique(old, new)
        return F.when(falsy(old), new).when(falsy(new) | (old == new), old).otherwise(F.concat_ws("; ", old, new))
    if strategy == REPLACE:
        return F.when(falsy(new, array), old).otherwise(new)
    if strategy == BETTER:
        longer = F.size(new) > F.size(old) if array else F.length(new) > F.length(old)
        return F.when(falsy(old, array) | (~falsy(new, array) & longer), new).otherwise(old)
    return old


def stored_attributes(items: DataFrame, config: Config | None = None, strict: bool = False) -> DataFrame:
    """Long form (uid, cluster, ord, entity_type, field, is_array, value): extracted fields under their stored names, lists exploded.

    Unknown fields are dropped, as the table has no column for them.
    """
    c = config or Config()
    spark = items.sparkSession
    known = [(t, f, f in c.arrays(t)) for t in c.entity_types() for f in [*c.scalars(t), *c.arrays(t)]]
    renames = [(t, k, v) for t in c.entity_types() for k, v in {**c.mappings.get("*", {}), **c.mappings.get(t, {})}.items()]
    long = items.select("uid", "cluster", "ord", "entity_type", F.explode("attributes").alias("field", "vs"))
    named = long.join(F.broadcast(spark.createDataFrame(renames, "entity_type string, field string, to string")), ["entity_type", "field"], "left").withColumn("field", F.coalesce("to", "field")).drop("to")
    kept = named.join(F.broadcast(spark.createDataFrame(known, "entity_type string, field string, is_array boolean")), ["entity_type", "field"])
    return kept.select("uid", "cluster", "ord", "entity_type", "field", "is_array", F.posexplode("vs").alias("at", "value")).where("value is not null")


def clusters_to_nodes(items: DataFrame, config: Config | None = None) -> DataFrame:
    """Nodes (type, name, fields) of clustered items (uid, cluster, ord, entity_type, entity_name, attributes).

    The first item names the node, other names become aliases; a scalar is the first non-empty value in order;
    arrays hold their distinct values in first-seen order. Values are de-duplicated before they are gathered, so a
    large cluster costs its distinct values only.
    """
    c = config or Config()
    long = stored_attributes(items, c).where("field <> 'name'").select("cluster", "ord", "at", "entity_type", "field", "is_array", "value")
    names = items.select("cluster", "ord", "entity_type", F.col("entity_name").alias("value"))
    head = names.groupBy("cluster").agg(F.min_by(F.struct(F.col("entity_type").alias("type"), F.col("value").alias("name")), "ord").alias("h")).select("cluster", "h.*")
    aliases = names.join(head, "cluster").where(F.col("value") != F.col("name")).select("cluster", "ord", F.lit(-1).alias("at"), "entity_type", F.lit("aliases").alias("field"), F.lit(True).alias("is_array"), "value")
    long = long.unionByName(aliases).where("value <> ''")
    once = long.groupBy("cluster", "field", "is_array", "value").agg(F.min(F.struct("ord", "at")).alias("o"))
    fields = once.groupBy("cluster", "field", "is_array").agg(F.transform(F.sort_array(F.collect_list(F.struct("o", "value"))), lambda x: x["value"]).alias("vs"))
    maps = fields.groupBy("cluster").agg(F.map_from_entries(F.collect_list(F.struct("field", "vs"))).alias("m"))
    none = F.array().cast("array<string>")
    at = lambda f: F.try_element_at("m", F.lit(f))
    scalars = [F.get(at(f), F.lit(0)).alias(f) for f in c.all_scalars() if f != "name"]
    arrays = [F.coalesce(at(f), none).alias(f) for f in c.all_arrays()]
    return head.join(maps, "cluster", "left").select("cluster", "type", "name", *scalars, *arrays)


def upsert_nodes(stored: DataFrame, new: DataFrame, config: Config | None = None, now: Column | None = None, key: tuple[str, ...] = ("type", "name")) -> DataFrame:
    """The table after a merge: new nodes are added, others merged field by field under their strategies; lastUpdated is stamped on touched rows.

    key=("name",) makes names unique across types; the new type then overwrites the old.
    """
    c = config or Config()
    names = stored.columns
    s, n = stored.alias("s"), new.alias("n")
    both = s.join(n, [F.col(f"s.{k}") == F.col(f"n.{k}") for k in key], "full")
    arrays = set(c.all_arrays())
    touched, fresh = F.col("n.name").isNotNull(), F.col("s.name").isNull()
    out = []
    for f in names:
        if f not in new.columns:
            out.append(F.col(f"s.{f}").alias(f))
            continue
        old, val = F.col(f"s.{f}"), F.col(f"n.{f}")
        if f in ("type", "name"):
            value = F.coalesce(val, old) if f == "type" else F.coalesce(old, val)
        elif f == "lastUpdated" and now is not None:
            value = F.when(touched, now.cast("string")).otherwise(old)
        else:
            array = f in arrays or stored.schema[f].dataType.simpleString().startswith("array")
            default = merged(old, val, c.strategies.get(("*", f), APPEND if array else PRESERVE), array)
            by_type = [(t, s_) for (t, g), s_ in c.strategies.items() if g == f and t != "*"]
            value = default
            for t, strategy in by_type:
                value = F.when(F.coalesce(F.col("n.type"), F.col("s.type")) == t, merged(old, val, strategy, array)).otherwise(value)
            value = F.when(fresh, val).when(touched, value).otherwise(old)
        out.append(value.alias(f))
    return both.select(*out)


def update_nodes(stored: DataFrame, updates: DataFrame, now: Column | None = None) -> DataFrame:
    """Rows of ``updates`` (type, name, some fields): arrays append what is new, other given values replace, missing nodes are ignored."""
    s, u = stored.alias("s"), updates.alias("u")
    both = s.join(u, (F.col("s.type") == F.col("u.type")) & (F.col("s.name") == F.col("u.name")), "left")
    out = []
    for f in stored.columns:
        old = F.col(f"s.{f}")
        if f in ("type", "name") or f not in updates.columns:
            value = F.when(F.col("u.name").isNotNull(), now.cast("string")).otherwise(old) if f == "lastUpdated" and now is not None else old
        elif stored.schema[f].dataType.simpleString() == "array<string>":
            value = F.when(F.col(f"u.{f}").isNotNull(), append_unique(old, F.col(f"u.{f}"))).otherwise(old)
        else:
            value = F.coalesce(F.col(f"u.{f}"), old)
        out.append(value.alias(f))
    return both.select(*out)


def delete_nodes(nodes: DataFrame, relations: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes without (type, name) of ``gone``, and relations without edges at them."""
    left = nodes.join(gone, ["type", "name"], "left_anti")
    for side in ("src", "dst"):
        relations = relations.join(gone.select(F.col("type").alias(f"{side}_type"), F.col("name").alias(f"{side}_name")), [f"{side}_type", f"{side}_name"], "left_anti")
    return left, relations


def processed_attributes(items: DataFrame, config: Config | None = None, from_agent: bool = False) -> DataFrame:
    """(uid, entity_type, attributes): extracted attributes under their stored names, as lists.

    Fields whose strategy leaves them to the agent are skipped unless they come from it. Values of fields that share a stored array come
    behind each other, the last of several fields wins a stored scalar, descriptions are always a list, and the type's arrays that no field
    fills are empty. ``items`` has uid, item_id, entity_type and attributes; the item's id joins the sources.
    """
    c = config or Config()
    spark = items.sparkSession
    targets = {t: list(dict.fromkeys([*c.scalars(t), *c.arrays(t)])) for t in c.entity_types()}
    gate = [(t, k, c.target(t, k), c.target(t, k) in c.arrays(t)) for t in targets for k in dict.fromkeys([*targets[t], *c.mappings.get(t, {}), *c.mappings.get("*", {}), *c.prompt_fields.get(t, ())]) if c.mergeable(t, k, from_agent) and c.mergeable(t, c.target(t, k), from_agent)]
    known = F.broadcast(spark.createDataFrame(gate, "entity_type string, field string, target string, is_array boolean"))
    mine = F.concat(F.transform(F.map_entries("attributes"), lambda e, i: F.struct(i.alias("at"), e["key"].alias("field"), e["value"].alias("vs"))), F.array(F.struct(F.lit(1 << 20).alias("at"), F.lit("sources").alias("field"), F.array("item_id").alias("vs"))))
    long = items.select("uid", "entity_type", F.explode(mine).alias("e")).select("uid", "entity_type", "e.*").join(known, ["entity_type", "field"])
    none = F.array().cast("array<string>")
    empty = spark.createDataFrame([(t, f) for t in targets for f in c.arrays(t) if c.mergeable(t, f, from_agent)], "entity_type string, target string")
    blank = items.select("uid", "entity_type").join(F.broadcast(empty), "entity_type").select("entity_type", "uid", F.lit(-1).alias("at"), "target", F.lit(True).alias("is_array"), none.alias("vs"))
    both = long.select("entity_type", "uid", "at", "target", "is_array", F.coalesce("vs", none).alias("vs")).unionByName(blank)
    one = both.groupBy("uid", "entity_type", "target", "is_array").agg(F.sort_array(F.collect_list(F.struct("at", "vs"))).alias("x"))
    values = F.when(F.col("is_array"), F.array_distinct(F.flatten(F.transform("x", lambda e: e["vs"])))).otherwise(F.element_at("x", -1)["vs"])
    return one.groupBy("uid", "entity_type").agg(F.map_from_entries(F.collect_list(F.struct(F.col("target"), values.alias("v")))).alias("attributes"))
