"""Relations: endpoints through the alias map, consolidation, upsert, delete."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entityflow.functions.embed import embed
from entityflow.functions.text import append_unique, normalise, relation_id, relation_text


def alias_map(items: DataFrame, heads: DataFrame) -> DataFrame:
    """(item_id, alias, name, type): every name of an item's document with its node. heads: (cluster, type, name)."""
    rows = items.join(heads, "cluster").select("item_id", normalise(F.col("entity_name")).alias("alias"), "name", "type", "ord")
    return rows.groupBy("item_id", "alias").agg(F.min_by(F.struct("name", "type"), "ord").alias("n")).select("item_id", "alias", "n.name", "n.type")


def with_endpoints(relations: DataFrame, aliases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(relations with src and dst nodes, relations with an unknown endpoint)."""
    side = lambda c: aliases.select("item_id", F.col("alias").alias(f"{c}_key"), F.col("name").alias(f"{c}_name"), F.col("type").alias(f"{c}_type"))
    keyed = relations.withColumns({"src_key": normalise(F.col("source_entity")), "dst_key": normalise(F.col("target_entity"))})
    both = keyed.join(side("src"), ["item_id", "src_key"], "left").join(side("dst"), ["item_id", "dst_key"], "left").drop("src_key", "dst_key")
    known = F.col("src_name").isNotNull() & F.col("dst_name").isNotNull()
    return both.where(known), both.where(~known)


LISTS = ("description", "relationTag", "permissions", "sources")


def consolidate(relations: DataFrame) -> DataFrame:
    """One row per (src, dst, type): distinct descriptions, sources, permissions and tags in first-seen order, the largest strength (missing: 1).

    Values are de-duplicated by a first aggregate before a second one gathers them; the strength goes through both.
    """
    key = ["src_type", "src_name", "dst_type", "dst_name", F.col("relationship_type").alias("type")]
    keys = ["src_type", "src_name", "dst_type", "dst_name", "type"]
    none = F.array().cast("array<string>")
    perms = F.col("permissions") if "permissions" in relations.columns else none
    columns = {"description": F.array("description"), "permissions": F.coalesce(perms, none), "sources": F.coalesce("sources", none)}

    def marked(i: int, values: Column) -> Column:
        return F.transform(F.filter(values, lambda v: v != ""), lambda v: F.struct(F.lit(i).alias("f"), v.alias("v")))

    def listed(i: int) -> Column:
        return F.transform(F.filter("xs", lambda x: x["f"] == i), lambda x: x["v"])

    # a row without values stays by a value of no list
    some = F.concat(*[marked(i, c) for i, c in enumerate(columns.values())])
    values = F.when(F.size(some) > 0, some).otherwise(F.array(F.struct(F.lit(-1).alias("f"), F.lit("").alias("v"))))
    long = relations.select(*key, F.coalesce("strength", F.lit(1.0)).alias("strength"), F.struct("item_id", "rel_no").alias("o"), F.posexplode(values).alias("at", "x"))
    once = long.groupBy(*keys, F.col("x.f").alias("f"), F.col("x.v").alias("v")).agg(F.min(F.struct("o", "at")).alias("o"), F.max("strength").alias("strength"))
    got = once.groupBy(*keys).agg(F.max("strength").alias("strength"), F.sort_array(F.collect_list(F.struct("f", "o", "v"))).alias("xs"))
    lists = {f: listed(i) for i, f in enumerate(columns)} | {"relationTag": F.when(F.col("type") != "", F.array("type")).otherwise(none)}
    return got.select(relation_id(F.col("src_name"), F.col("type"), F.col("dst_name")).alias("relation_id"), *keys, "strength", *[lists[f].alias(f) for f in LISTS])


def consolidate_into(stored: DataFrame, relations: DataFrame, embedder=None, now: Column | None = None) -> DataFrame:
    """The relation table after a merge: consolidated, upserted, and touched rows embedded anew from their merged texts."""
    new = consolidate(relations)
    merged = upsert_relations(stored, new, now)
    fresh = new.select("relation_id", "src_type", "dst_type", F.lit(True).alias("_new"))
    both = merged.join(fresh, ["relation_id", "src_type", "dst_type"], "left")
    said = relation_text(F.col("relationTag"), F.col("type"), F.col("description"), F.col("strength"))
    vector = embed(F.when(F.col("_new"), said), embedder)
    return both.withColumn("embedding", F.when(F.col("_new"), vector).otherwise(F.col("embedding"))).select(*stored.columns)


def with_known_ends(relations: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(relations whose two typed ends are stored nodes, the others)."""
    keys = nodes.select("type", "name").distinct()
    out = relations
    for side in ("src", "dst"):
        ends = keys.select(F.col("type").alias(f"{side}_type"), F.col("name").alias(f"{side}_name"), F.lit(True).alias(f"_{side}"))
        out = out.join(ends, [f"{side}_type", f"{side}_name"], "left")
    known = F.col("_src").isNotNull() & F.col("_dst").isNotNull()
    return out.where(known).select(*relations.columns), out.where(~known).select(*relations.columns)


def upsert_relations(stored: DataFrame, new: DataFrame, now: Column | None = None) -> DataFrame:
    """Union of arrays, larger strength; createdAt on new rows, lastUpdated on touched ones."""
    s, n = stored.alias("s"), new.alias("n")
    keys = ["relation_id", "src_type", "dst_type"]
    both = s.join(n, [F.col(f"s.{k}").eqNullSafe(F.col(f"n.{k}")) for k in keys], "full")
    touched, fresh = F.col("n.relation_id").isNotNull(), F.col("s.relation_id").isNull()
    stamp = now.cast("string") if now is not None else F.lit(None).cast("string")
    out = []
    for f in stored.columns:
        old = F.col(f"s.{f}")
        if f in LISTS:
            value = F.when(touched, F.array_distinct(append_unique(old, F.col(f"n.{f}")))).otherwise(old)
        elif f == "strength":
            value = F.greatest(old, F.col("n.strength"))
        elif f == "createdAt":
            value = F.when(fresh, stamp).otherwise(old)
        elif f == "lastUpdated":
            value = F.when(touched, stamp).otherwise(old)
        else:
            value = F.coalesce(F.col(f"n.{f}"), old) if f in new.columns else old
        out.append(value.alias(f))
    return both.select(*out)


def update_relations(stored: DataFrame, updates: DataFrame, now: Column | None = None) -> DataFrame:
    """Rows of ``updates`` (relation_id, some fields): arrays append what is new, given scalars replace; unknown ids are ignored."""
    s, u = stored.alias("s"), updates.alias("u")
    both = s.join(u, F.col("s.relation_id") == F.col("u.relation_id"), "left")
    out = []
    for f in stored.columns:
        old = F.col(f"s.{f}")
        if f == "lastUpdated" and now is not None:
            value = F.when(F.col("u.relation_id").isNotNull(), now.cast("string")).otherwise(old)
        elif f == "relation_id" or f not in updates.columns:
            value = old
        elif stored.schema[f].dataType.simpleString() == "array<string>":
            value = F.when(F.col(f"u.{f}").isNotNull(), append_unique(old, F.col(f"u.{f}"))).otherwise(old)
        else:
            value = F.coalesce(F.col(f"u.{f}"), old)
        out.append(value.alias(f))
    return both.select(*out)


def delete_relations(relations: DataFrame, gone: DataFrame) -> DataFrame:
    return relations.join(gone.select("relation_id"), "relation_id", "left_anti")


def attach_permissions(results: DataFrame, documents: DataFrame) -> DataFrame:
    """Rows with item_id and permissions; a document's non-empty permissions overwrite, otherwise nothing changes."""
    d = documents.select("item_id", F.col("permissions").alias("_p")).dropDuplicates(["item_id"])
    joined = results.join(d, "item_id", "left")
    old = F.col("permissions") if "permissions" in results.columns else F.array().cast("array<string>")
    return joined.withColumn("permissions", F.when(F.size("_p") > 0, F.col("_p")).otherwise(old)).drop("_p")
