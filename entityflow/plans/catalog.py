"""Registry of the engine's own queries on the test tables and the SQL they are compared with."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityflow.config import BETTER, PRESERVE, RULES, Config
from entityflow.functions import parse, text
from entityflow.operators import graph, match, merge, quality, relations
from entityflow.plans.pipeline import extracted, items_of, saver
from entityflow.sources import documents as sources
from entityflow.sources import sinks
from entityflow.streaming.ingest import latest_status, unprocessed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def folder(spark: SparkSession) -> str:
    """A new folder where the session keeps shared files; a temporary one only where it names none (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or "file://" + tempfile.mkdtemp(prefix="entityflow-")
    return f"{base.rstrip('/')}/queries/{uuid.uuid4().hex}"


def _save(spark: SparkSession):
    """Written tables in the shared folder."""
    return saver(spark, folder(spark))


# -- stand-ins: typed nodes and edges of the star schema ------------------------------
def _nodes(spark: SparkSession, d: str) -> DataFrame:
    rows = [("customer", "Person", "c_name"), ("supplier", "Organization", "s_name"), ("part", "Project", "p_name"), ("nation", "Team", "n_name"), ("region", "Topic", "r_name")]
    out = None
    for table, kind, name in rows:
        x = _t(spark, d, table).select(F.lit(kind).alias("type"), F.col(name).alias("name"))
        out = x if out is None else out.unionByName(x)
    return out


_NODES = "SELECT 'Person' AS type, c_name AS name FROM customer UNION ALL SELECT 'Organization', s_name FROM supplier UNION ALL SELECT 'Project', p_name FROM part UNION ALL SELECT 'Team', n_name FROM nation UNION ALL SELECT 'Topic', r_name FROM region"


def _edges(spark: SparkSession, d: str) -> DataFrame:
    """customer -> nation -> region with a tag."""
    n = _t(spark, d, "nation")
    a = _t(spark, d, "customer").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).select(F.lit("Person").alias("src_type"), F.col("c_name").alias("src_name"), F.lit("Team").alias("dst_type"), F.col("n_name").alias("dst_name"), F.lit("LIVES_IN").alias("type"))
    b = n.join(F.broadcast(_t(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey")).select(F.lit("Team"), F.col("n_name"), F.lit("Topic"), F.col("r_name"), F.lit("PART_OF"))
    return a.union(b).withColumn("relationTag", F.array(F.lit("place"), F.col("type"))).withColumn("strength", F.lit(1.0)).withColumn("description", F.array("type"))


_EDGES = "SELECT 'Person' AS src_type, c_name AS src_name, 'Team' AS dst_type, n_name AS dst_name, 'LIVES_IN' AS type FROM customer JOIN nation ON c_nationkey = n_nationkey UNION ALL SELECT 'Team', n_name, 'Topic', r_name, 'PART_OF' FROM nation JOIN region ON n_regionkey = r_regionkey"


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), "text", "source")


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Documents to entities to clusters: nodes by type."""
    save = _save(spark)
    items = save(items_of(extracted(_docs(spark, d)).where("error is null")))
    clusters = match.resolve(items, RULES, save)
    heads = items.select("uid", "entity_type").join(clusters, "uid").where("uid = cluster")
    return heads.groupBy(F.col("entity_type").alias("type")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "type")


# -- counts and distributions ---------------------------------------------------------
@query(f"SELECT type, count(*) AS n FROM ({_NODES}) GROUP BY type")
def node_type_distribution(spark, d):
    return graph.type_distribution(_nodes(spark, d))


@query(f"WITH t(type) AS (VALUES ('Person'),('Team'),('Organization'),('Project'),('Repository'),('Branch'),('CodeChangeRequest'),('Issue'),('Event'),('Topic')) SELECT t.type, count(x.name) AS n FROM t LEFT JOIN ({_NODES}) x ON x.type = t.type GROUP BY t.type")
def type_counts_with_zero(spark, d):
    return graph.type_counts(_nodes(spark, d), Config().entity_types())


@query(f"SELECT 'place,' || type AS tags, count(*) AS n FROM ({_EDGES}) GROUP BY type")
def edge_count_by_tag(spark, d):
    return graph.edges_by_tags(_edges(spark, d)).select(F.array_join("relationTag", ",").alias("tags"), "n")


@query(f"SELECT count(*) AS n FROM ({_EDGES})")
def edge_count(spark, d):
    return graph.GraphSession(spark, _nodes(spark, d).withColumn("permissions", F.array()), _edges(spark, d)).stats()[1].select(F.col("relations").alias("n"))


# -- progress -------------------------------------------------------------------------
@query("SELECT doc_id, source FROM documents WHERE NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)")
def unprocessed_anti_join(spark, d):
    done = _t(spark, d, "labels").select(F.col("doc_id").alias("item_id"), F.lit("processed").alias("status"))
    return unprocessed(_t(spark, d, "documents").select("doc_id", "source"), done, "doc_id")


@query("""WITH s AS (SELECT user_id, CASE WHEN event_type = 'purchase' THEN 'processed' WHEN event_type = 'error' THEN 'failed' ELSE 'reset' END AS status, ts FROM events),
l AS (SELECT user_id, status FROM s QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY (status = 'processed') DESC, ts DESC, status DESC) = 1)
SELECT count(*) FILTER (status = 'processed') AS processed, count(*) FILTER (status = 'failed') AS failed,
 round(coalesce(100.0 * count(*) FILTER (status = 'processed') / nullif(count(*) FILTER (status IN ('processed', 'failed')), 0), 0)::DOUBLE, 6) AS success_rate FROM l""")
def progress_latest_status(spark, d):
    kind = F.when(F.col("event_type") == "purchase", "processed").when(F.col("event_type") == "error", "failed").otherwise("reset")
    log = _t(spark, d, "events").select(F.col("user_id").alias("item_id"), kind.alias("status"), F.col("ts").alias("at"))
    s = latest_status(log).agg(F.count_if(F.col("status") == "processed").alias("processed"), F.count_if(F.col("status") == "failed").alias("failed"))
    return s.withColumn("success_rate", F.round(text.success_rate(F.col("processed"), F.col("failed")), 6))


# -- documents ------------------------------------------------------------------------
@query("SELECT doc_id, length(coalesce(source, '') || chr(10) || chr(10) || coalesce(text, ''))::BIGINT AS n, sha256(coalesce(source, '') || chr(10) || chr(10) || coalesce(text, '')) AS digest FROM documents")
def prepare_text(spark, d):
    docs = _t(spark, d, "documents").withColumnsRenamed({"source": "title", "text": "content"})
    return sources.prepare(docs).select("doc_id", F.length("text").cast("long").alias("n"), F.sha2("text", 256).alias("digest"))


@query("SELECT conv_id, sha256(string_agg(coalesce(text, ''), ' ' ORDER BY turn, text)) AS digest, count(*) AS chunks FROM conversations GROUP BY conv_id")
def mail_chunks_join(spark, d):
    c = _t(spark, d, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", F.coalesce("text", F.lit("")).alias("text")))).alias("ms"))
    record = F.struct(F.col("conv_id").cast("string").alias("id"), F.struct(F.transform("ms", lambda x: x["text"]).alias("chunks"), F.size("ms").alias("n")).alias("fields"))
    v = sources.parse_visit(c.select(F.to_json(record).alias("value")))
    return v.select(F.col("id").cast("long").alias("conv_id"), F.sha2("content", 256).alias("digest"), F.col("metadata")["n"].cast("long").alias("chunks"))


@query("SELECT event_id, epoch_ms(date_trunc('second', ts)) // 1000 AS from_seconds, epoch_ms(date_trunc('second', ts)) // 1000 AS from_millis, epoch_ms(date_trunc('second', ts)) // 1000 AS from_text FROM events")
def timestamp_units(spark, d):
    e = _t(spark, d, "events").withColumn("s", F.unix_timestamp("ts"))
    back = lambda c: F.unix_timestamp(text.timestamp(c))
    return e.select("event_id", back(F.col("s").cast("string")).alias("from_seconds"), back((F.col("s") * 1000).cast("string")).alias("from_millis"), back(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("from_text"))


@query("SELECT event_id, event_type FROM events WHERE ts > TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 48 HOUR")
def recent_documents(spark, d):
    e = _t(spark, d, "events").withColumnRenamed("ts", "timestamp")
    return sources.recent(e, F.lit("2024-01-30 00:00:00").cast("timestamp"), 48).select("event_id", "event_type")


@query("SELECT doc_id FROM documents WHERE contains(lower(concat_ws(' ', source, text)), 'apache') AND contains(lower(concat_ws(' ', source, text)), 'license')")
def content_search(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", F.col("source").alias("title"), F.col("text").alias("content"))
    return sources.query(docs, "Apache License").select("doc_id")


@query("SELECT doc_id, lang FROM documents WHERE lang = 'fr' AND source = 'src3'")
def filtered_query(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "lang", "source", F.col("lang").alias("doc_type"))
    return sources.query(docs, doc_type="fr", filters={"source": "src3"}).select("doc_id", "lang")


@query("SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 3")
def per_type_topk_export(spark, d):
    return sinks.top_per_type(_t(spark, d, "documents").select("doc_id", "source"), 3, "source", "doc_id")


@query("SELECT doc_id, lang FROM documents WHERE lang IN ('en', 'fr', 'xx') QUALIFY row_number() OVER (PARTITION BY lang ORDER BY doc_id) <= 33")
def per_type_quota(spark, d):
    return sources.per_type(_t(spark, d, "documents").select("doc_id", "lang"), ["en", "fr", "xx"], 100, "lang", "doc_id")


@query("SELECT doc_id, lang, n_chars FROM documents")
def projected_export(spark, d):
    return sinks.projected(_t(spark, d, "documents"), ["doc_id", "lang", "n_chars", "no_such_field"])


@query("SELECT source, count(*) AS n FROM documents GROUP BY source")
def documents_by_type(spark, d):
    return graph.type_distribution(_t(spark, d, "documents").select(F.col("source").alias("type"))).select(F.col("type").alias("source"), "n")


# -- tuple parsing --------------------------------------------------------------------
def _tuples(spark, d):
    c = _t(spark, d, "customer").join(F.broadcast(_t(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    raw = F.concat(F.lit('Some prose first.\n("entity"<|>"'), F.col("c_name"), F.lit('"<|>Person<|>"worksAt": "'), F.col("n_name"), F.lit('"<|>"role": "['), F.lower("c_mktsegment"), F.lit(', buyer]")##\n("relationship"<|>'), F.col("c_name"), F.lit("<|>"), F.col("n_name"), F.lit("<|>LIVES_IN<|>\"lives there\"<|>strength "), F.col("c_nationkey").cast("string"), F.lit(".5)##\n<|COMPLETE|>"))
    return parse.parsed(c.select(F.col("c_custkey").alias("item_id"), raw.alias("raw_output")))


@query("SELECT c_custkey AS item_id, c_name AS name, 'Person' AS type, n_name AS works_at, lower(c_mktsegment) || '|buyer' AS roles, c_custkey::VARCHAR AS sources FROM customer JOIN nation ON c_nationkey = n_nationkey")
def tuple_parse_entities(spark, d):
    e = parse.entity_items(_tuples(spark, d))
    a = lambda k: F.array_join(e["attributes"][k], "|")
    return e.select("item_id", F.col("entity_name").alias("name"), F.col("entity_type").alias("type"), a("worksAt").alias("works_at"), a("role").alias("roles"), a("sources").alias("sources"))


@query("SELECT c_custkey AS item_id, c_name AS src, n_name AS dst, 'LIVES_IN' AS type, 'lives there' AS description, c_nationkey + 0.5::DOUBLE AS strength FROM customer JOIN nation ON c_nationkey = n_nationkey")
def tuple_parse_relationships(spark, d):
    r = parse.relation_items(_tuples(spark, d))
    return r.select("item_id", F.col("source_entity").alias("src"), F.col("target_entity").alias("dst"), F.col("relationship_type").alias("type"), "description", "strength")


# -- resolution -----------------------------------------------------------------------
def _items(df: DataFrame, uid: str, kind: str, name: str, attributes: list) -> DataFrame:
    return df.select(F.col(uid).alias("uid"), F.lit(kind).alias("entity_type"), F.col(name).alias("entity_name"), F.create_map(*attributes).alias("attributes"), F.array(F.lit("aliases")).alias("list_keys"))


@query("SELECT p_partkey AS uid, min(p_partkey) OVER (PARTITION BY lower(trim(p_name))) AS cluster FROM part")
def lowercase_name_resolution(spark, d):
    p = _t(spark, d, "part")
    items = _items(p, "p_partkey", "Project", "p_name", [F.lit("name"), F.array(F.concat(F.lit("  "), F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).otherwise(F.col("p_name")), F.lit("\t")))])
    return match.resolve(items, RULES, _save(spark))


@query("WITH RECURSIVE e AS (SELECT DISTINCT a.p_partkey AS x, b.p_partkey AS y FROM (SELECT p_partkey, unnest([lower(p_brand), lower(p_type)]) AS k FROM part) a JOIN (SELECT lower(p_brand) AS k, min(p_partkey) AS p_partkey FROM part GROUP BY 1 UNION ALL SELECT lower(p_type), min(p_partkey) FROM part GROUP BY 1) b USING (k)), s AS (SELECT x, y FROM e UNION SELECT y, x FROM e), r AS (SELECT p_partkey AS x, p_partkey AS y FROM (SELECT min(p_partkey) AS p_partkey FROM part) UNION SELECT r.x, s.y FROM r JOIN s ON s.x = r.y) SELECT p_partkey AS uid, coalesce((SELECT min(x) FROM r WHERE r.y = p_partkey), p_partkey) AS cluster FROM part")
def list_overlap_match(spark, d):
    """Alias lists of brand and type: overlapping lists chain into components."""
    p = _t(spark, d, "part")
    items = _items(p, "p_partkey", "Topic", "p_partkey", [F.lit("aliases"), F.array("p_brand", "p_type"), F.lit("name"), F.array(F.concat(F.lit("n"), F.col("p_partkey").cast("string")))]).withColumn("entity_name", F.concat(F.lit("n"), F.col("uid").cast("string")))
    return match.resolve(items, RULES, _save(spark))


@query("WITH RECURSIVE e AS (SELECT n_nationkey::BIGINT AS x, (100 + n_regionkey)::BIGINT AS y FROM nation UNION ALL SELECT (1000 + s_suppkey)::BIGINT, s_nationkey::BIGINT FROM supplier), s AS (SELECT x, y FROM e UNION SELECT y, x FROM e), r AS (SELECT x AS a, x AS b FROM s UNION SELECT r.a, s.y FROM r JOIN s ON s.x = r.b WHERE s.y > 0 OR s.y = 0) SELECT b AS node, min(a) AS component FROM r GROUP BY b")
def transitive_closure(spark, d):
    n = _t(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("src"), (F.col("n_regionkey") + 100).cast("long").alias("dst"))
    s = _t(spark, d, "supplier").select((F.col("s_suppkey") + 1000).cast("long").alias("src"), F.col("s_nationkey").cast("long").alias("dst"))
    from entityflow.operators.components import connected_components

    return connected_components(n.unionByName(s), _save(spark))


@query("WITH h AS (SELECT c.c_custkey AS uid, n.n_name AS name, 1 AS p FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey UNION ALL SELECT c.c_custkey, r.r_name, 2 FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey) SELECT uid, name, p::INTEGER AS priority FROM h WHERE p = 1 OR uid NOT IN (SELECT uid FROM h WHERE p = 1) QUALIFY row_number() OVER (PARTITION BY uid ORDER BY p, name) = 1")
def rule_priority_pick(spark, d):
    """Customers look for a stored organisation by domain (their nation) before the name (their region)."""
    n, r = _t(spark, d, "nation"), _t(spark, d, "region")
    c = _t(spark, d, "customer").join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"))
    items = c.select(F.col("c_custkey").alias("uid"), F.lit("Organization").alias("entity_type"), F.col("r_name").alias("entity_name"), F.create_map(F.lit("domain"), F.array(F.lower("n_name")), F.lit("name"), F.array("r_name")).alias("attributes"), F.array().cast("array<string>").alias("list_keys"))
    nodes = n.select(F.lit("Organization").alias("type"), F.col("n_name").alias("name"), F.col("n_name").alias("domain")).unionByName(r.select(F.lit("Organization").alias("type"), F.col("r_name").alias("name"), F.lit(None).cast("string").alias("domain"))).withColumn("aliases", F.array().cast("array<string>"))
    return match.match_stored(items, nodes, RULES).select("uid", "name", "priority")


# -- merging --------------------------------------------------------------------------
@query("SELECT o_custkey AS cluster, arg_min(o_orderstatus, o_orderkey) FILTER (o_orderstatus <> 'O') AS status, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS tags FROM orders GROUP BY o_custkey")
def first_non_empty_scalar(spark, d):
    o = _t(spark, d, "orders")
    items = o.select(F.col("o_orderkey").alias("uid"), F.col("o_custkey").alias("cluster"), F.col("o_orderkey").alias("ord"), F.lit("Project").alias("entity_type"), F.lit("x").alias("entity_name"), F.create_map(F.lit("status"), F.array(F.when(F.col("o_orderstatus") == "O", "").otherwise(F.col("o_orderstatus"))), F.lit("tags"), F.array("o_orderpriority")).alias("attributes"))
    return merge.clusters_to_nodes(items).select("cluster", "status", F.array_join(F.sort_array("tags"), ",").alias("tags"))


@query("WITH x AS (SELECT o_custkey AS k, list(DISTINCT o_orderpriority) FILTER (o_orderstatus = 'O') AS a, list(DISTINCT o_orderpriority) FILTER (o_orderstatus <> 'O') AS b FROM orders GROUP BY 1) SELECT k, array_to_string(list_sort(list_distinct(list_concat(coalesce(a, []), coalesce(b, [])))), ',') AS vs, len(list_distinct(list_concat(coalesce(a, []), coalesce(b, []))))::INTEGER AS n FROM x")
def append_unique(spark, d):
    o = _t(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.collect_set(F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority"))).alias("a"), F.collect_set(F.when(F.col("o_orderstatus") != "O", F.col("o_orderpriority"))).alias("b"))
    return o.select("k", text.append_unique(F.col("a"), F.col("b")).alias("v")).select("k", F.array_join(F.sort_array("v"), ",").alias("vs"), F.size("v").alias("n"))


@query("WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderstatus END AS o, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS n FROM orders) SELECT o_orderkey, CASE WHEN o = '' THEN n ELSE o END AS preserved, CASE WHEN n IS NULL THEN o ELSE n END AS replaced, CASE WHEN o = '' OR (n IS NOT NULL AND length(n) > length(o)) THEN n ELSE o END AS better, o AS agent FROM x")
def merge_strategies(spark, d):
    x = _t(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.col("o_orderstatus")).alias("o"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).alias("n"))
    o, n = F.col("o"), F.col("n")
    return x.select("o_orderkey", merge.merged(o, n, PRESERVE).alias("preserved"), merge.merged(o, n, "replace_always").alias("replaced"), merge.merged(o, n, BETTER).alias("better"), merge.merged(o, n, "agent_only").alias("agent"))


def _stored(spark, d):
    n = _t(spark, d, "nation")
    return n.where("n_nationkey < 20").select(F.lit("Team").alias("type"), F.col("n_name").alias("name"), F.array(F.lit("a"), F.lit("a"), F.lower("n_name")).alias("aliases"), F.lit("old").alias("cleanDescription"))


@query("SELECT n_name AS name, CASE WHEN n_nationkey < 20 AND n_nationkey >= 10 THEN 'a,a,' || lower(n_name) || ',b' WHEN n_nationkey < 20 THEN 'a,a,' || lower(n_name) ELSE 'a,b' END AS aliases, CASE WHEN n_nationkey < 20 THEN 'old' ELSE 'new' END AS cd FROM nation")
def upsert_nodes(spark, d):
    new = _t(spark, d, "nation").where("n_nationkey >= 10").select(F.lit("Team").alias("type"), F.col("n_name").alias("name"), F.array(F.lit("a"), F.lit("b")).alias("aliases"), F.lit("new").alias("cleanDescription"))
    return merge.upsert_nodes(_stored(spark, d), new).select("name", F.array_join("aliases", ",").alias("aliases"), F.col("cleanDescription").alias("cd"))


@query("SELECT n_name AS name, 'a,a,' || lower(n_name) || CASE WHEN n_nationkey % 2 = 0 THEN ',z' ELSE '' END AS aliases, CASE WHEN n_nationkey % 2 = 0 THEN 'upd' ELSE 'old' END AS cd FROM nation WHERE n_nationkey < 20")
def update_nodes(spark, d):
    u = _t(spark, d, "nation").where("n_nationkey % 2 = 0").select(F.lit("Team").alias("type"), F.col("n_name").alias("name"), F.array(F.lit("a"), F.lit("z")).alias("aliases"), F.lit("upd").alias("cleanDescription"))
    return merge.update_nodes(_stored(spark, d), u).select("name", F.array_join("aliases", ",").alias("aliases"), F.col("cleanDescription").alias("cd"))


@query(f"WITH g AS (SELECT n_name FROM nation WHERE n_nationkey < 5) SELECT 'node' AS kind, type AS a, name AS b FROM ({_NODES}) WHERE NOT (type = 'Team' AND name IN (SELECT n_name FROM g)) UNION ALL SELECT 'edge', src_name, dst_name FROM ({_EDGES}) WHERE NOT (src_type = 'Team' AND src_name IN (SELECT n_name FROM g)) AND NOT (dst_type = 'Team' AND dst_name IN (SELECT n_name FROM g))")
def delete_node_cascade(spark, d):
    gone = _t(spark, d, "nation").where("n_nationkey < 5").select(F.lit("Team").alias("type"), F.col("n_name").alias("name"))
    n, e = merge.delete_nodes(_nodes(spark, d), _edges(spark, d), gone)
    return n.select(F.lit("node").alias("kind"), F.col("type").alias("a"), F.col("name").alias("b")).unionByName(e.select(F.lit("edge").alias("kind"), F.col("src_name").alias("a"), F.col("dst_name").alias("b")))


# -- relations ------------------------------------------------------------------------
@query(f"SELECT src_name, dst_name, sha256(src_name || '::' || type || '::' || dst_name) AS relation_id, sha256(src_name || '::' || type || '::place::' || dst_name) AS tagged_id FROM ({_EDGES})")
def relation_ids(spark, d):
    s, k, t = F.col("src_name"), F.col("type"), F.col("dst_name")
    return _edges(spark, d).select("src_name", "dst_name", text.relation_id(s, k, t).alias("relation_id"), text.tagged_relation_id(s, k, F.lit("place"), t).alias("tagged_id"))


@query("SELECT l_partkey::VARCHAR AS src_name, l_suppkey::VARCHAR AS dst_name, l_returnflag AS type, max(l_quantity) AS strength, string_agg(DISTINCT l_linestatus, ',' ORDER BY l_linestatus) AS descriptions FROM lineitem GROUP BY ALL")
def relation_consolidation(spark, d):
    li = _t(spark, d, "lineitem").select(F.lit("Project").alias("src_type"), F.col("l_partkey").cast("string").alias("src_name"), F.lit("Organization").alias("dst_type"), F.col("l_suppkey").cast("string").alias("dst_name"), F.col("l_returnflag").alias("relationship_type"), F.col("l_linestatus").alias("description"), F.col("l_quantity").alias("strength"), F.col("l_orderkey").alias("item_id"), F.col("l_linenumber").alias("rel_no"), F.array(F.col("l_returnflag")).alias("sources"))
    return relations.consolidate(li).select("src_name", "dst_name", "type", "strength", F.array_join(F.sort_array("description"), ",").alias("descriptions"))


def _mapped(spark, d):
    """Orders as relations customer -> clerk priority; aliases are customers of even key, one document for all."""
    o = _t(spark, d, "orders").select(F.lit(0).alias("item_id"), F.col("o_orderkey").alias("rel_no"), F.concat(F.lit(" C"), F.col("o_custkey").cast("string")).alias("source_entity"), F.upper("o_orderpriority").alias("target_entity"))
    c = _t(spark, d, "customer").where("c_custkey % 2 = 0").select(F.lit(0).alias("item_id"), F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("alias"), F.col("c_name").alias("name"), F.lit("Person").alias("type"))
    p = _t(spark, d, "orders").select(F.lit(0).alias("item_id"), F.lower("o_orderpriority").alias("alias"), F.col("o_orderpriority").alias("name"), F.lit("Topic").alias("type")).distinct()
    return relations.with_endpoints(o, c.unionByName(p))


@query("SELECT o_orderkey AS rel_no, c_name AS src_name, o_orderpriority AS dst_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_custkey % 2 = 0")
def canonical_endpoint_join(spark, d):
    return _mapped(spark, d)[0].select("rel_no", "src_name", "dst_name")


@query("SELECT o_orderkey AS rel_no, o_orderpriority AS dst_name FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 2 = 0) c ON o_custkey = c_custkey WHERE c_custkey IS NULL")
def rejected_relations(spark, d):
    return _mapped(spark, d)[1].select("rel_no", "dst_name")


@query(f"WITH e AS ({_EDGES}), x AS (SELECT 'outgoing' AS direction, type AS relation, dst_type AS other_type, dst_name AS other_name FROM e WHERE src_type = 'Team' AND src_name = (SELECT n_name FROM nation WHERE n_nationkey = 7) UNION ALL SELECT 'incoming', type, src_type, src_name FROM e WHERE dst_type = 'Team' AND dst_name = (SELECT n_name FROM nation WHERE n_nationkey = 7)) SELECT * FROM x ORDER BY direction, relation, other_type, other_name LIMIT 20")
def neighbourhood_one_hop(spark, d):
    name = _t(spark, d, "nation").where("n_nationkey = 7").first()["n_name"]
    return graph.neighbours(_nodes(spark, d), _edges(spark, d), "Team", name).select("direction", "relation", "other_type", "other_name")


@query(f"SELECT count(*) AS n, min(src_name) AS first_src FROM ({_EDGES}) WHERE src_type = 'Team' AND dst_type = 'Topic' AND src_name = (SELECT n_name FROM nation WHERE n_nationkey = 7)")
def edges_between(spark, d):
    n = _t(spark, d, "nation").where("n_nationkey = 7").join(F.broadcast(_t(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey")).first()
    return graph.between(_edges(spark, d), ("Team", n["n_name"]), ("Topic", n["r_name"]), "place").agg(F.count("*").alias("n"), F.min("src_name").alias("first_src"))


@query(f"WITH e AS ({_EDGES}) SELECT a.src_name AS person, a.dst_name AS team, b.dst_name AS topic FROM e a JOIN e b ON a.dst_type = b.src_type AND a.dst_name = b.src_name WHERE a.src_type = 'Person'")
def person_org_pattern(spark, d):
    return graph.two_hops(_edges(spark, d), "Person").toDF("person", "team", "topic")


# -- vectors --------------------------------------------------------------------------
_COS = "list_cosine_similarity(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0))"


@query(f"SELECT vec_id, round(1 - {_COS}, 6) AS distance, round(greatest(0, {_COS}) * 100, 4) AS similarity FROM embeddings ORDER BY 1 - {_COS}, vec_id LIMIT 10")
def vector_topk(spark, d):
    e = _t(spark, d, "embeddings")
    q = e.where("vec_id = 0").first()["embedding"]
    top = graph.vector_top_k(e, q, 10, tie="vec_id")
    return top.select("vec_id", F.round("distance", 6).alias("distance"), F.round(text.similarity_percent(F.col("distance")), 4).alias("similarity"))


@query(f"WITH v AS (SELECT vec_id, label, {_COS} AS c FROM embeddings) SELECT a.vec_id AS src, b.vec_id AS dst, round((a.c + b.c) / 2, 6) AS score FROM v a JOIN v b ON b.vec_id = a.vec_id + 1 WHERE a.label = 3 AND b.label = 3 AND (a.c + b.c) / 2 > -0.2")
def hybrid_permission_search(spark, d):
    e = _t(spark, d, "embeddings")
    q = e.where("vec_id = 0").first()["embedding"]
    nodes = e.select(F.lit("Person").alias("type"), F.col("vec_id").cast("string").alias("name"), "embedding", F.array(F.col("label").cast("string")).alias("permissions"))
    edges = e.select(F.lit("Person").alias("src_type"), F.col("vec_id").cast("string").alias("src_name"), F.lit("Person").alias("dst_type"), (F.col("vec_id") + 1).cast("string").alias("dst_name"), F.lit("NEXT").alias("type"), F.array(F.col("label").cast("string")).alias("permissions"))
    return graph.hybrid_search(nodes, edges, q, "3", -0.2).select(F.col("src_name").cast("long").alias("src"), F.col("dst_name").cast("long").alias("dst"), F.round("score", 6).alias("score"))


# -- quality --------------------------------------------------------------------------
@query("SELECT count(*) AS total, count(l.doc_id) AS covered, round(100.0 * count(l.doc_id) / count(*), 6)::DOUBLE AS percent FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id")
def source_coverage(spark, d):
    x = _t(spark, d, "documents").select("doc_id").join(_t(spark, d, "labels").select("doc_id", F.lit(1).alias("there")), "doc_id", "left")
    x = x.select(F.col("doc_id").cast("string").alias("item_id"), F.when(F.col("there") == 1, F.array(F.col("doc_id").cast("string"))).otherwise(F.array().cast("array<string>")).alias("sources"))
    return quality.source_coverage(x).withColumn("percent", F.round("percent", 6))


@query("SELECT count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS covered, round(100.0 * count(*) FILTER (o_orderstatus = 'F') / count(*), 6)::DOUBLE AS percent FROM orders")
def permission_coverage(spark, d):
    docs = _t(spark, d, "orders").select(F.col("o_orderkey").alias("item_id"), F.when(F.col("o_orderstatus") == "F", F.array("o_orderpriority")).otherwise(F.array().cast("array<string>")).alias("permissions"))
    rows = relations.attach_permissions(_t(spark, d, "orders").select(F.col("o_orderkey").alias("item_id")), docs)
    return quality.permission_coverage(rows).withColumn("percent", F.round("percent", 6))


@query("SELECT d.doc_id, array_to_string(list_filter([CASE WHEN l.quality IS NULL THEN 'quality' END, CASE WHEN l.toxic IS NULL THEN 'toxic' END], lambda x: x IS NOT NULL), ',') AS missing FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE l.quality IS NULL OR l.toxic IS NULL")
def quality_missing_fields(spark, d):
    x = _t(spark, d, "documents").select("doc_id").join(_t(spark, d, "labels"), "doc_id", "left")
    return quality.missing(x, ["quality", "toxic"]).select("doc_id", F.array_join("missing", ",").alias("missing"))


@query("SELECT sum(n_chars)::BIGINT AS entities, count(*) AS documents FROM documents")
def batch_totals(spark, d):
    r = _t(spark, d, "documents").select(F.col("n_chars").alias("entity_count"), F.lit(0).alias("relationship_count"), F.lit(None).cast("string").alias("error"))
    return quality.batch_totals(r).select("entities", "documents")


# -- texts and ids --------------------------------------------------------------------
@query("SELECT p_partkey, concat_ws('. ', 'Project', 'Name: ' || p_name, 'Description: ' || p_brand || ' ' || p_type || ' c', 'Role: ' || p_brand) AS said FROM part")
def embedding_text(spark, d):
    desc = F.array(F.lit(""), F.col("p_brand"), F.col("p_type"), F.lit("c"), F.lit("never shown"))
    return _t(spark, d, "part").select("p_partkey", text.entity_text(F.lit("Project"), F.col("p_name"), desc, role=F.col("p_brand")).alias("said"))


@query("SELECT c_custkey, sha256('Person::' || CASE WHEN c_custkey % 3 = 0 THEN 'email::' || lower(c_name) || '@x.org' WHEN c_custkey % 3 = 1 THEN 'name_worksAt::' || lower(c_name) || '::' || lower(c_mktsegment) ELSE 'name::' || lower(c_name) END) AS entity_id FROM customer")
def entity_id_legacy(spark, d):
    k = F.col("c_custkey") % 3
    mail = F.when(k == 0, F.concat(F.lower("c_name"), F.lit("@x.org")))
    return _t(spark, d, "customer").select("c_custkey", text.entity_id(F.lit("Person"), F.col("c_name"), mail, F.when(k == 1, F.col("c_mktsegment")), F.lit(None).cast("string")).alias("entity_id"))


@query("SELECT event_id, CASE WHEN event_type = 'view' THEN 'email' WHEN event_type = 'error' THEN 'code' WHEN event_type = 'click' THEN 'chat' ELSE 'email' END AS kind FROM events")
def data_type_detection(spark, d):
    has = {"subject": F.col("event_type") == "view", "commit": F.col("event_type") == "error", "channel": F.col("event_type") == "click"}
    return _t(spark, d, "events").select("event_id", text.data_type(F.lit(None).cast("string"), has).alias("kind"))


@query("SELECT type, name FROM (" + _NODES + ") WHERE type = 'Person' AND name = (SELECT min(c_name) FROM customer)")
def point_lookup(spark, d):
    nodes = _nodes(spark, d).withColumns({"permissions": F.array().cast("array<string>")})
    first = _t(spark, d, "customer").agg(F.min("c_name")).first()[0]
    return graph.GraphSession(spark, nodes, _edges(spark, d)).entity("Person", first).select("type", "name")


@query("SELECT type, count(*) AS n FROM (" + _NODES + ") WHERE name > 'M' GROUP BY type")
def parameterised_sql(spark, d):
    return graph.GraphSession(spark, _nodes(spark, d), _edges(spark, d)).sql("SELECT type, count(*) AS n FROM nodes WHERE name > :low GROUP BY type", low="M")


@query(r"""WITH d AS (SELECT coalesce(source, 'unknown') AS source, text FROM documents WHERE regexp_matches(coalesce(text, ''), '\S')), m AS (SELECT unnest(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+')) AS mail FROM d)
SELECT 'Topic' AS type, count(DISTINCT lower(source)) AS n FROM d HAVING count(*) > 0 UNION ALL SELECT 'Person', count(DISTINCT lower(split_part(mail, '@', 1))) FROM m HAVING count(*) > 0 UNION ALL SELECT 'Organization', count(DISTINCT lower(split_part(mail, '@', 2))) FROM m HAVING count(*) > 0""")
def extraction_to_types(spark, d):
    """The flagship on any size: extractor, parser, rules, components."""
    return flagship(spark, d)


from entityflow.plans import catalog_store  # noqa: E402, F401  registers its queries here
