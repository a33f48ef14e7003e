"""The extraction tuple grammar as column expressions: text -> entity and relationship structs.

Records stand on lines of their own, parts are separated by ``<|>``, records end with ``##``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import strip

# Fixed values of the format.
ENTITY, RELATION, RECORD_END, PART, DONE = '("entity"', '("relationship"', "##", r"<\|>", "<|COMPLETE|>"
DEFAULT_STRENGTH = 5.0


def _bare(c: Column) -> Column:
    """Stripped, then without quotes at the ends."""
    return F.regexp_replace(strip(c), r'^"+|"+$', "")


def records(text: Column) -> Column:
    """Records of a text: lines that begin with a marker, or the whole text if no line does."""
    lines = F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x.startswith(ENTITY) | x.startswith(RELATION))
    section = F.when(F.size(lines) > 0, F.array_join(lines, "\n")).otherwise(text)
    return F.filter(F.transform(F.split(section, RECORD_END), strip), lambda r: (r != "") & (r != DONE))


def _parts(record: Column) -> Column:
    inner = F.when(record.endswith(")"), F.regexp_replace(record, r"(?s)^\((.*)\)$", "$1")).otherwise(record)
    return F.split(inner, PART)


_VALUE = r'^"([^"]+)":\s*"([^"]*)"'
#: Parts that a record needs.
ENTITY_PARTS, RELATION_PARTS = 3, 6


def parsed(df: DataFrame, text: str = "raw_output", item_id: str = "item_id") -> DataFrame:
    """Add the documents' records by kind and their numbers; too short ones are left out. ``entity_items`` and ``relation_items`` read them."""
    found = df.withColumn("_records", records(F.coalesce(F.col(text), F.lit(""))))
    parts = lambda r: F.size(F.split(r, PART))
    kept = found.withColumns({
        "entity_records": F.filter("_records", lambda r: r.startswith(ENTITY) & (parts(r) >= ENTITY_PARTS)),
        "relation_records": F.filter("_records", lambda r: r.startswith(RELATION) & (parts(r) >= RELATION_PARTS)),
    })
    return kept.drop("_records").withColumns({"entity_count": F.size("entity_records"), "relationship_count": F.size("relation_records")})


def entity_items(df: DataFrame, item_id: str = "item_id") -> DataFrame:
    """One row per entity: item_id, batch_id (place in its document), entity_name, entity_type, attributes, list_keys; the last of equal keys wins.

    Records are exploded first and every step is a column of its own, so no expression is repeated inside another.
    """
    keep = [F.col(c) for c in ("permissions",) if c in df.columns]
    r = df.select(F.col(item_id).alias("item_id"), *keep, F.posexplode("entity_records").alias("batch_id", "_record")).withColumn("_p", _parts(F.col("_record")))
    r = r.withColumns({"entity_name": _bare(F.get("_p", F.lit(1))), "entity_type": _bare(F.get("_p", F.lit(2))), "_a": F.filter(F.transform(F.slice("_p", 4, F.greatest(F.size("_p"), F.lit(1))), strip), lambda a: F.regexp_like(a, F.lit(_VALUE)))})
    r = r.withColumns({"_k": F.transform("_a", lambda a: F.regexp_extract(a, _VALUE, 1)), "_v": F.transform("_a", lambda a: F.regexp_extract(a, _VALUE, 2))})
    is_list = lambda v: v.startswith("[") & v.endswith("]")
    r = r.withColumns({"_at": F.filter(F.transform("_k", lambda k, i: i), lambda i: (F.array_position(F.slice(F.col("_k"), i + 2, F.size("_k")), F.get("_k", i)) == 0) & ~F.get("_k", i).isin("name", "sources")), "_inner": F.transform("_v", lambda v: F.when(is_list(v), F.regexp_replace(v, r"(?s)^\[(.*)\]$", "$1")))})
    # null: no list; an empty list has no elements
    r = r.withColumn("_vs", F.transform("_inner", lambda x, i: F.when(x.isNull(), F.array(F.get("_v", i))).when(x == "", F.array().cast("array<string>")).otherwise(F.transform(F.split(x, ","), _bare))))
    own = F.flatten(F.filter(F.transform("_k", lambda k, i: F.when(k == "sources", F.get("_vs", i))), lambda v: v.isNotNull()))
    none = F.array().cast("array<struct<k:string,v:array<string>>>")
    entry = lambda k, v: F.array(F.struct(F.lit(k).alias("k"), v.alias("v")))
    plain = F.concat(F.transform("_at", lambda i: F.struct(F.get("_k", i).alias("k"), F.get("_vs", i).alias("v"))), F.when(F.size("_p") > ENTITY_PARTS, entry("name", F.array("entity_name"))).otherwise(none), entry("sources", F.array_distinct(F.concat(own, F.array(F.col("item_id").cast("string"))))))
    lists = F.concat(F.transform(F.filter("_at", lambda i: F.get("_inner", i).isNotNull()), lambda i: F.get("_k", i)), F.array(F.lit("sources")))
    return r.select("item_id", "batch_id", "entity_name", "entity_type", F.map_from_entries(plain).alias("attributes"), lists.alias("list_keys"), *keep)


def relation_items(df: DataFrame, item_id: str = "item_id") -> DataFrame:
    """One row per relationship: item_id, rel_no, endpoints, type, description, strength (the first number of its part, 5.0 without one), sources."""
    keep = [F.col(c) for c in ("permissions",) if c in df.columns]
    r = df.select(F.col(item_id).alias("item_id"), *keep, F.posexplode("relation_records").alias("rel_no", "_record")).withColumn("_p", _parts(F.col("_record")))
    r = r.withColumn("_n", F.regexp_extract(F.get("_p", F.lit(5)), r"(\d+(?:\.\d+)?)", 1))
    at = lambda i: _bare(F.get("_p", F.lit(i)))
    return r.select("item_id", "rel_no", at(1).alias("source_entity"), at(2).alias("target_entity"), at(3).alias("relationship_type"), at(4).alias("description"), F.when(F.col("_n") != "", F.col("_n").cast("double")).otherwise(DEFAULT_STRENGTH).alias("strength"), F.array(F.col("item_id").cast("string")).alias("sources"), *keep)


def gathered(results: DataFrame, items: DataFrame, rels: DataFrame) -> DataFrame:
    """Extraction results with a document's entities and relationships in arrays again, in order: the shape that is saved as JSON."""
    e = items.groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct("batch_id", "entity_name", "entity_type", F.to_json("attributes").alias("attributes"), "list_keys"))).alias("entities"))
    r = rels.groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct("rel_no", "source_entity", "target_entity", "relationship_type", "description", "strength", "sources"))).alias("relationships"))
    return results.drop("entity_records", "relation_records").join(e, "item_id", "left").join(r, "item_id", "left")
