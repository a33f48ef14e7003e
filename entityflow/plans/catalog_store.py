"""Further queries of the catalogue: files, stores, sessions, relations and settings, each through its library operator."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityflow.config import RULES, Config, Settings
from entityflow.functions import embed, extract, parse, text
from entityflow.operators import graph, match, merge, quality, relations
from entityflow.plans import pipeline
from entityflow.plans.catalog import _EDGES, _NODES, _edges, _nodes, _save, _t, folder, query
from entityflow.schema import GraphStore, nodes_schema, relations_schema, separate, unify
from entityflow.sources import documents as sources
from entityflow.sources import sinks
from entityflow.streaming import ingest as streaming

NOW = "2024-01-01T00:00:00"


def _rows(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def _joined(c: str, sep: str = "|"):
    return F.array_join(c, sep)


# -- documents as JSON ----------------------------------------------------------------
def _visits(spark, d) -> DataFrame:
    """Documents as visit records: the id outside, inside or under docId; recipients as a list, a scalar or missing; text as chunks or whole."""
    k = F.col("doc_id") % 3
    fields = F.struct(
        F.when(k == 1, F.col("doc_id").cast("string")).alias("docId"), F.when(k == 2, F.col("doc_id").cast("string")).alias("id"), F.when(k != 0, F.col("source")).alias("subject"),
        F.when(k == 0, F.array("text", F.lit("end"))).alias("chunks"), F.when(k == 1, F.col("lang")).alias("from"), F.when(k == 2, F.array("lang", F.lit("x"))).alias("to"), F.lit(1704067200000).alias("timestamp"), F.col("source").alias("extra"),
    )
    return _t(spark, d, "documents").select(F.to_json(F.struct(F.when(k == 0, F.col("doc_id").cast("string")).alias("id"), fields.alias("fields"))).alias("value"))


@query("SELECT doc_id::VARCHAR AS id, CASE WHEN doc_id % 3 = 0 THEN 'No subject' ELSE source END AS title, sha256(CASE WHEN doc_id % 3 = 0 THEN coalesce(text || ' ', '') || 'end' ELSE '' END) AS digest, CASE WHEN doc_id % 3 = 1 THEN lang ELSE 'Unknown sender' END AS source, CASE WHEN doc_id % 3 = 2 THEN lang || '|x' ELSE '' END AS recipients, 1704067200::BIGINT AS at, source AS extra FROM documents")
def visit_documents(spark, d):
    v = sources.parse_visit(_visits(spark, d))
    return v.select("id", "title", F.sha2("content", 256).alias("digest"), "source", _joined("to").alias("recipients"), F.unix_timestamp("timestamp").alias("at"), F.col("metadata")["extra"].alias("extra"))


@query("SELECT count(*) AS n, count(DISTINCT doc_id) AS ids, sum(length(CASE WHEN doc_id % 3 = 0 THEN 'No subject' ELSE source END) + 2 + CASE WHEN doc_id % 3 = 0 THEN length(coalesce(text || ' ', '')) + 3 ELSE 0 END)::BIGINT AS characters FROM documents")
def fetch_all_prepared(spark, d):
    return sources.fetch_all(_visits(spark, d)).agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"), F.sum(F.length("text")).alias("characters"))


def _hits(spark, d) -> DataFrame:
    odd = F.col("doc_id") % 2 == 1
    fields = F.struct(F.when(odd, F.col("source")).alias("title"), F.when(~odd, F.col("lang")).alias("subject"), F.when(odd, F.lit("c")).alias("content"), F.lit("b").alias("body"), F.col("lang").alias("from"), F.when(F.col("doc_id") % 5 == 0, F.lit("note")).alias("doc_type"), F.col("n_chars").alias("more"))
    return _t(spark, d, "documents").select(F.to_json(F.struct(F.col("doc_id").cast("string").alias("id"), fields.alias("fields"))).alias("value"))


@query("SELECT doc_id::VARCHAR AS id, CASE WHEN doc_id % 2 = 1 THEN source ELSE lang END AS title, CASE WHEN doc_id % 2 = 1 THEN 'c' ELSE 'b' END AS content, lang AS source, CASE WHEN doc_id % 5 = 0 THEN 'note' ELSE 'document' END AS doc_type, n_chars::VARCHAR AS more FROM documents")
def search_hits(spark, d):
    return sources.parse_hit(_hits(spark, d)).select("id", "title", "content", "source", "doc_type", F.col("metadata")["more"].alias("more"))


@query("SELECT doc_id::VARCHAR AS id, CASE WHEN doc_id % 2 = 1 THEN source ELSE 'Untitled' END AS title, CASE WHEN doc_id % 2 = 1 THEN 'c' ELSE '' END AS content, NULL::VARCHAR AS source FROM documents")
def point_documents(spark, d):
    return sources.parse_hit(_hits(spark, d), fallbacks=False).select("id", "title", "content", "source")


def _documents(spark, d) -> DataFrame:
    return _t(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("source").alias("title"), F.col("text").alias("content"), F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("doc_type"), F.when(F.col("doc_id") % 4 == 0, "2024-01-01T00:00:00").otherwise("garbage").alias("timestamp"), F.create_map(F.lit("k"), F.col("lang")).alias("metadata"), F.col("lang").alias("source"))


@query("SELECT doc_id::VARCHAR AS id, source AS title, CASE WHEN doc_id % 2 = 0 THEN lang ELSE 'document' END AS doc_type, CASE WHEN doc_id % 4 = 0 THEN 1704067200::BIGINT END AS at, lang AS k FROM documents")
def document_json_round_trip(spark, d):
    back = sources.from_json_text(sources.to_json_text(_documents(spark, d)))
    return back.select("id", "title", "doc_type", F.unix_timestamp("timestamp").alias("at"), F.col("metadata")["k"].alias("k"))


@query("SELECT doc_id::VARCHAR AS id, source AS title FROM documents WHERE doc_id = (SELECT min(doc_id) FROM documents)")
def document_by_id(spark, d):
    first = _t(spark, d, "documents").agg(F.min("doc_id")).first()[0]
    return sources.by_id(_documents(spark, d), str(first)).select("id", "title")


@query("SELECT event_id::VARCHAR AS id, event_type || chr(10) || chr(10) || user_id AS text FROM events WHERE ts > TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 24 HOUR")
def fetch_recent_prepared(spark, d):
    e = _t(spark, d, "events").select(F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("title"), F.col("user_id").cast("string").alias("content"), F.col("ts").alias("timestamp"))
    return sources.fetch_recent(e, F.lit("2024-01-30 00:00:00").cast("timestamp")).select("id", "text")


@query("SELECT doc_id::VARCHAR AS id, length(source || chr(10) || chr(10) || text)::BIGINT AS n FROM documents WHERE contains(lower(concat_ws(' ', source, text)), 'license')")
def search_prepared(spark, d):
    return sources.search_content(_documents(spark, d), "LICENSE", 10**9).select("id", F.length("text").cast("long").alias("n"))


@query("SELECT least(7, count(*)) AS n, least(7, count(DISTINCT doc_id)) AS ids FROM documents")
def truncated_visit(spark, d):
    return sources.visit_all(_documents(spark, d), 7).agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"))


@query("SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'meeting' WHEN event_id % 7 = 1 THEN 'email' WHEN event_id % 7 = 2 THEN 'code' WHEN event_id % 7 = 3 THEN 'meeting' WHEN event_id % 7 = 4 THEN 'chat' WHEN event_id % 7 = 5 THEN 'document' ELSE 'email' END AS kind FROM events")
def data_type_of_record(spark, d):
    k = F.col("event_id") % 7
    key = F.when(k == 0, '{"data_type":"Meeting","to":1}').when(k == 1, '{"data_type":"odd","sender":"x","commit":1}').when(k == 2, '{"commit":null,"channel":1}').when(k == 3, '{"agenda":[]}').when(k == 4, '{"thread":{"to":1}}').when(k == 5, '{"data_type":"document"}').otherwise('{"x":{"commit":1}}')
    return _t(spark, d, "events").select("event_id", text.data_type_of(key).alias("kind"))


# -- exports --------------------------------------------------------------------------
@query("SELECT doc_id::VARCHAR AS id, source AS title, lang AS source FROM documents")
def json_lines_round_trip(spark, d):
    at = folder(spark)
    sinks.export(_documents(spark, d), at, "lines")
    return sources.read_json_lines(spark, at).select("id", "title", "source")


@query("SELECT n_nationkey::VARCHAR AS id, n_name AS title, 'document' AS doc_type FROM nation")
def json_file_documents(spark, d):
    at = folder(spark)
    n = _t(spark, d, "nation").select(F.struct(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("title")).alias("x"))
    bad = F.struct(F.lit(None).cast("string").alias("id"), F.lit("no id").alias("title"))
    n.groupBy().agg(F.to_json(F.struct(F.concat(F.collect_list("x"), F.array(bad)).alias("documents"))).alias("value")).write.text(at)
    return sources.read_json_documents(spark, at).select("id", "title", "doc_type")


@query("SELECT count(*) AS total_documents, true AS has_bytes, false AS include_metadata FROM documents")
def json_export_statistics(spark, d):
    s = sinks.export(_documents(spark, d), folder(spark), "json", NOW, include_metadata=False)
    return s.select("total_documents", (F.col("bytes") > 2).alias("has_bytes"), "include_metadata")


@query("SELECT count(*) AS total_documents, true AS indented FROM nation")
def pretty_json_export(spark, d):
    at = folder(spark)
    s = sinks.export_json(_t(spark, d, "nation"), at, NOW, pretty=True)
    lines = spark.read.text(f"{at}/documents").agg(F.count_if(F.col("value").startswith("  ")).alias("n"))
    return s.join(lines).select("total_documents", (F.col("n") >= F.col("total_documents")).alias("indented"))


@query("SELECT t.lang AS doc_type, least(5, count(d.doc_id)) AS n, CASE WHEN count(d.doc_id) > 0 THEN 'exported' ELSE 'no documents' END AS status FROM (VALUES ('en'), ('fr'), ('xx')) t(lang) LEFT JOIN documents d ON d.lang = t.lang GROUP BY 1")
def export_by_type_status(spark, d):
    docs = _t(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("doc_type"), "source")
    return sinks.export(docs, folder(spark), "by_type", types=["en", "fr", "xx"], limit=5)


@query("SELECT doc_id::VARCHAR AS id, source AS title FROM documents")
def light_export(spark, d):
    at = folder(spark)
    sinks.export(_documents(spark, d), at, "light", fields=["id", "title", "none"])
    return spark.read.schema("id string, title string").json(at)


@query("SELECT doc_id, lang FROM documents")
def saved_results(spark, d):
    at = folder(spark)
    sinks.save_results(_t(spark, d, "documents").select("doc_id", "lang"), at, "r1")
    return spark.read.schema("doc_id long, lang string").json(f"{at}/run=r1")


# -- extraction -----------------------------------------------------------------------
class _Echo:
    def extract(self, texts):
        return [f'("entity"<|>{t}<|>Team<|>"description": "one of {len(t)}")##' for t in texts]


@query("SELECT n_nationkey::VARCHAR AS item_id, n_name AS name, 'Team' AS type, 'one of ' || length(n_name) AS said FROM nation")
def extract_with_plugin(spark, d):
    docs = _t(spark, d, "nation").select(F.col("n_nationkey").alias("item_id"), F.col("n_name").alias("text"))
    e = parse.entity_items(parse.parsed(extract.extract_with(docs, _Echo())))
    return e.select("item_id", F.col("entity_name").alias("name"), F.col("entity_type").alias("type"), F.col("attributes")["description"][0].alias("said"))


@query("SELECT n_nationkey::VARCHAR AS item_id, CASE WHEN n_nationkey % 2 = 0 THEN 'empty content' END AS error, CASE WHEN n_nationkey % 2 = 0 THEN 0 ELSE 1 END AS entity_count FROM nation")
def failed_extractions(spark, d):
    docs = _t(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("id"), F.when(F.col("n_nationkey") % 2 == 0, " ").otherwise(F.col("n_name")).alias("text"), F.lit("s").alias("source"))
    return pipeline.extracted(docs, _Echo()).select("item_id", "error", "entity_count")


@query("SELECT c_custkey AS item_id, 2 AS n, c_name || '|' || n_name AS names, 1 AS relations FROM customer JOIN nation ON n_nationkey = c_nationkey")
def gathered_results(spark, d):
    c = _t(spark, d, "customer").join(F.broadcast(_t(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    raw = F.concat(F.lit('("entity"<|>'), F.col("c_name"), F.lit('<|>Person)##\n("entity"<|>'), F.col("n_name"), F.lit('<|>Team<|>"k": "v"<|>"k": "w")##\n("relationship"<|>a<|>b<|>T<|>d<|>1)##'))
    r = parse.parsed(c.select(F.col("c_custkey").alias("item_id"), raw.alias("raw_output")))
    out = parse.gathered(r, parse.entity_items(r), parse.relation_items(r))
    return out.select("item_id", F.size("entities").alias("n"), F.array_join(F.transform("entities", lambda e: e["entity_name"]), "|").alias("names"), F.size("relationships").alias("relations"))


@query("SELECT p_partkey, 1.0::DOUBLE AS same, round(2.0 / 3, 6)::DOUBLE AS doubled, 0.0::DOUBLE AS nothing FROM part")
def sequence_similarity(spark, d):
    n, r = F.col("p_name"), lambda a, b: F.round(text.sequence_ratio(a, b), 6)
    return _t(spark, d, "part").select("p_partkey", r(n, n).alias("same"), r(n, F.concat(n, F.translate(n, "abcdefghijklmnopqrstuvwxyz 0123456789", "##################################### "))).alias("doubled"), r(n, F.lit("~~~")).alias("nothing"))


# -- texts, ids, vectors --------------------------------------------------------------
@query("""SELECT s_suppkey, sha256(CASE WHEN s_suppkey % 4 = 0 THEN 'Organization::domain::' || lower(s_name) || '.org' WHEN s_suppkey % 4 = 1 THEN 'Organization::name::' || lower(s_name)
 WHEN s_suppkey % 4 = 2 THEN 'Topic::name::' || lower(s_name) ELSE 'Topic::fallback::{"k": "' || s_name || '", "l": ["a", "b"]}' END) AS entity_id FROM supplier""")
def entity_id_all_keys(spark, d):
    k, n = F.col("s_suppkey") % 4, F.col("s_name")
    attributes = F.create_map(F.lit("l"), F.array(F.lit("a"), F.lit("b")), F.lit("k"), F.array(n))
    none = F.lit(None).cast("string")
    made = text.entity_id(F.when(k < 2, "Organization").otherwise("Topic"), F.when(k.isin(1, 2), n), none, none, F.when(k == 0, F.concat(n, F.lit(".org"))), text.json_text(attributes, F.array(F.lit("l"))))
    return _t(spark, d, "supplier").select("s_suppkey", made.alias("entity_id"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN c_name WHEN c_custkey % 4 = 1 THEN c_mktsegment WHEN c_custkey % 4 = 2 THEN 'User_' || c_custkey ELSE sha256('') END AS name FROM customer")
def fallback_names(spark, d):
    k, none = F.col("c_custkey") % 4, F.lit(None).cast("string")
    return _t(spark, d, "customer").select("c_custkey", text.fallback_name(F.when(k == 0, F.col("c_name")).otherwise(F.when(k == 1, "")), F.when(k == 1, F.col("c_mktsegment")), F.when(k == 2, F.concat(F.col("c_custkey").cast("string"), F.lit("@x.org"))).otherwise(none)).alias("name")).withColumn("name", F.when(F.col("c_custkey") % 4 == 3, F.sha2(F.lit(""), 256)).otherwise(F.col("name")))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'Generic relation' WHEN o_orderkey % 3 = 1 THEN 'Relation: A, B. Description: ' || o_orderpriority || '. Strength: 2.0' ELSE 'Relation: T' END AS said FROM orders")
def relation_texts(spark, d):
    k, none = F.col("o_orderkey") % 3, F.array().cast("array<string>")
    one = k == 1
    return _t(spark, d, "orders").select("o_orderkey", text.relation_text(F.when(one, F.array(F.lit("A"), F.lit("B"))).otherwise(none), F.when(k == 2, "T").otherwise(""), F.when(one, F.array("o_orderpriority")).otherwise(none), F.when(one, F.lit(2.0))).alias("said"))


@query("SELECT doc_id, CASE WHEN trim(coalesce(text, '')) = '' THEN (CASE WHEN coalesce(text, '') = '' THEN NULL ELSE 64 END) ELSE 64 END AS dim, CASE WHEN coalesce(text, '') = '' THEN NULL WHEN trim(text, ' ' || chr(9) || chr(10) || chr(13)) = '' THEN 0.0 ELSE 1.0 END::DOUBLE AS norm FROM documents")
def embedding_sizes(spark, d):
    e = _t(spark, d, "documents").select("doc_id", embed.embed(F.col("text"), embed.HashingEmbedder(64)).alias("e"))
    square = F.aggregate(F.transform("e", lambda x: x.cast("double") * x.cast("double")), F.lit(0.0).cast("double"), lambda s, x: s + x)
    return e.select("doc_id", F.when(F.col("e").isNotNull(), F.size("e")).alias("dim"), F.when(F.col("e").isNotNull(), F.round(square, 3)).alias("norm"))


def _letters(texts):
    """Token vectors (letter code, 1) of up to eight letters, and their mask."""
    out, mask = np.zeros((len(texts), 8, 2)), np.zeros((len(texts), 8), np.int64)
    for i, t in enumerate(texts):
        for j, c in enumerate(t[:8]):
            out[i, j], mask[i, j] = (ord(c), 1), 1
    return out, mask


@query("SELECT n_nationkey, round(list_avg([unicode(x) FOR x IN string_split(n_name[1:8], '')]), 3)::DOUBLE AS mean, 1.0::DOUBLE AS one FROM nation")
def pooled_embeddings(spark, d):
    e = _t(spark, d, "nation").select("n_nationkey", embed.embed(F.col("n_name"), embed.PooledEmbedder(_letters, 2)).alias("e"))
    return e.select("n_nationkey", F.round(F.col("e")[0].cast("double"), 3).alias("mean"), F.col("e")[1].cast("double").alias("one"))


# -- configuration and commands -------------------------------------------------------
@query("SELECT * FROM (VALUES ('Person', 5, 6, 4, 'email,name,alias,sourceSystemId'), ('Team', 3, 4, 2, 'name,alias'), ('Organization', 5, 5, 3, 'domain,name,alias'), ('Project', 7, 5, 2, 'name,alias'), ('Repository', 5, 4, 2, 'url,name'), ('Branch', 6, 4, 2, 'name,repo'), ('CodeChangeRequest', 10, 5, 2, 'name,title'), ('Issue', 8, 6, 2, 'name,id'), ('Event', 6, 4, 1, 'name'), ('Topic', 3, 6, 2, 'name,alias')) t(type, scalars, arrays, n_rules, rules)")
def config_accessors(spark, d):
    c = Config(rules=RULES[::-1])
    return _rows(spark, [(t, len(c.scalars(t)), len(c.arrays(t)), len(c.rules_of(t)), ",".join(r.match for r in c.rules_of(t))) for t in c.entity_types()], "type string, scalars int, arrays int, n_rules int, rules string")


@query("SELECT * FROM (VALUES ('Person', 'email', 'emails', 'preserve_existing', true), ('Person', 'description', 'rawDescriptions', 'append_unique', true), ('Event', 'title', 'name', 'preserve_existing', true), ('Organization', 'industry', 'industry', 'replace_if_better', true), ('Team', 'secret', 'secret', 'agent_only', false), ('Issue', 'status', 'status', 'replace_always', true)) t(type, extracted, stored, strategy, mergeable)")
def field_mapping_and_strategy(spark, d):
    c = Config()
    c.strategies[("Team", "secret")] = "agent_only"
    asked = [("Person", "email"), ("Person", "description"), ("Event", "title"), ("Organization", "industry"), ("Team", "secret"), ("Issue", "status")]
    return _rows(spark, [(t, f, c.target(t, f), c.strategy(t, c.target(t, f)), c.mergeable(t, c.target(t, f))) for t, f in asked], "type string, extracted string, stored string, strategy string, mergeable boolean")


@query("SELECT * FROM (VALUES ('details Ann Lee Person', 'details', 'Ann Lee|Person'), ('relations Acme Organization', 'relations', 'Acme|Organization'), ('top 99 graph db', 'search', 'graph db|50'), ('top 0 x', 'search', 'x|1'), ('simple a b', 'simple', 'a b'), ('stats', 'stats', ''), ('quit', 'exit', ''), ('', 'help', ''), ('who is it', 'search', 'who is it|10')) t(line, command, arguments)")
def search_commands(spark, d):
    lines = ["details Ann Lee Person", "relations Acme Organization", "top 99 graph db", "top 0 x", "simple a b", "stats", "quit", "", "who is it"]
    return _rows(spark, [(x, c, "|".join(map(str, a))) for x in lines for c, a in [graph.parse_command(x)]], "line string, command string, arguments string")


@query("SELECT * FROM (VALUES ('batch_size', '7', ''), ('page_size', '100', ''), ('retry_failed', 'True', ''), ('bad', '', 'batch_size must be greater than 0'), ('word', '', 'max_hits must be a whole number, not ''x''')) t(name, value, problem)")
def environment_settings(spark, d):
    s = Settings.from_env({"ENTITYFLOW_BATCH_SIZE": "7", "ENTITYFLOW_RETRY_FAILED": "yes"})
    rows = [(k, str(getattr(s, k)), "") for k in ("batch_size", "page_size", "retry_failed")]
    for name, env in (("bad", {"ENTITYFLOW_BATCH_SIZE": "0"}), ("word", {"ENTITYFLOW_MAX_HITS": "x"})):
        try:
            Settings.from_env(env)
        except ValueError as e:
            rows.append((name, "", str(e)))
    return _rows(spark, rows, "name string, value string, problem string")


@query("SELECT * FROM (VALUES ('type', 'string'), ('name', 'string'), ('x', 'array<string>'), ('e', 'array<float>'), ('y', 'date')) t(field, kind)")
def schema_union(spark, d):
    made = unify({"A": {"name": "STRING PRIMARY KEY", "x": "STRING[]"}, "B": {"x": "STRING", "e": "FLOAT[8]", "f": "ANY"}, "C": {"e": "STRING", "y": "DATE"}})
    return _rows(spark, [(f.name, f.dataType.simpleString()) for f in made.fields], "field string, kind string")


@query("SELECT * FROM (VALUES ('default', 'A', 10), ('own', 'A,B', 2)) t(name, types, relation_fields)")
def schema_split(spark, d):
    rows = []
    for name, schema in (("default", {"A": {"x": "STRING"}}), ("own", {"A": {}, "Relation": {"relation_id": "STRING", "w": "FLOAT"}, "B": {}})):
        types, relation = separate(schema)
        rows.append((name, ",".join(types), len(relation)))
    return _rows(spark, rows, "name string, types string, relation_fields int")


@query("SELECT * FROM (VALUES ('nodes', 'type', 'string'), ('nodes', 'name', 'string'), ('nodes', 'emails', 'array<string>'), ('nodes', 'startDate', 'date'), ('nodes', 'embedding', 'array<float>'), ('relations', 'relation_id', 'string'), ('relations', 'src_type', 'string'), ('relations', 'relationTag', 'array<string>'), ('relations', 'strength', 'double')) t(tab, field, kind)")
def table_schemas(spark, d):
    asked = {"nodes": ("type", "name", "emails", "startDate", "embedding"), "relations": ("relation_id", "src_type", "relationTag", "strength")}
    kinds = {"nodes": nodes_schema(), "relations": relations_schema()}
    return _rows(spark, [(t, f, kinds[t][f].dataType.simpleString()) for t, fs in asked.items() for f in fs], "tab string, field string, kind string")


# -- attributes and lookups -----------------------------------------------------------
def _people(spark, d) -> DataFrame:
    c = _t(spark, d, "customer").join(F.broadcast(_t(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    mail = F.concat(F.lower(F.translate("c_name", " #", "__")), F.lit("@x.org"))
    k = F.col("c_custkey") % 3
    attributes = F.map_filter(F.create_map(F.lit("email"), F.when(k == 0, F.array(mail)), F.lit("name"), F.array("c_name"), F.lit("worksAt"), F.when(k == 1, F.array("n_name")), F.lit("description"), F.array("c_mktsegment"), F.lit("nosuch"), F.array(F.lit("x"))), lambda _, v: v.isNotNull())
    return c.select(F.col("c_custkey").alias("uid"), F.col("c_custkey").cast("string").alias("item_id"), F.lit("Person").alias("entity_type"), F.col("c_name").alias("entity_name"), attributes.alias("attributes"), F.array().cast("array<string>").alias("list_keys"), mail.alias("mail"), "n_name")


@query("SELECT c_custkey AS uid, CASE WHEN c_custkey % 3 = 0 THEN lower(replace(replace(c_name, ' ', '_'), '#', '_')) || '@x.org' ELSE '' END AS emails, c_name AS name, CASE WHEN c_custkey % 3 = 1 THEN n_name END AS works_at, c_mktsegment AS descriptions, c_custkey::VARCHAR AS sources, 8 - CASE WHEN c_custkey % 3 = 1 THEN 0 ELSE 1 END AS fields FROM customer JOIN nation ON n_nationkey = c_nationkey")
def processed_attributes(spark, d):
    p = merge.processed_attributes(_people(spark, d))
    a = lambda k: F.col("attributes")[k]
    return p.select("uid", _joined(a("emails")).alias("emails"), a("name")[0].alias("name"), a("worksAt")[0].alias("works_at"), _joined(a("rawDescriptions")).alias("descriptions"), _joined(a("sources")).alias("sources"), F.size("attributes").alias("fields"))


@query("SELECT c_custkey AS uid, CASE WHEN c_custkey % 3 = 0 THEN 'mail ' ELSE '' END || c_name AS name, CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 3 END AS step FROM customer WHERE c_custkey % 3 < 2")
def legacy_lookup(spark, d):
    p = _people(spark, d)
    none = F.array().cast("array<string>")
    mailed = p.select(F.lit("Person").alias("type"), F.concat(F.lit("mail "), F.col("entity_name")).alias("name"), F.array("mail").alias("emails"), F.lit(None).cast("string").alias("worksAt"))
    placed = p.select(F.lit("Person").alias("type"), F.col("entity_name").alias("name"), none.alias("emails"), F.col("n_name").alias("worksAt"))
    return match.legacy_lookup(p, mailed.unionByName(placed))


@query("SELECT p_partkey AS uid, min(p_partkey) OVER (PARTITION BY p_brand) AS cluster FROM part")
def resolution_without_rules(spark, d):
    items = _t(spark, d, "part").select(F.col("p_partkey").alias("uid"), F.lit("Widget").alias("entity_type"), F.concat(F.lit(" "), F.when(F.col("p_partkey") % 2 == 0, F.upper("p_brand")).otherwise(F.col("p_brand"))).alias("entity_name"), F.create_map().cast("map<string,array<string>>").alias("attributes"), F.array().cast("array<string>").alias("list_keys"))
    return match.resolve(items, RULES, _save(spark))


# -- relations ------------------------------------------------------------------------
def _relations(spark, d) -> DataFrame:
    """The stand-in edges as a relation table: even nations' edges have two sources."""
    e = _edges(spark, d)
    rid = text.relation_id(F.col("src_name"), F.col("type"), F.col("dst_name"))
    return e.select(rid.alias("relation_id"), "src_type", "src_name", "dst_type", "dst_name", "description", "relationTag", "type", F.lit(2.0).alias("strength"), F.array().cast("array<string>").alias("permissions"), F.array(F.lit("a")).alias("sources"), F.lit("old").alias("createdAt"), F.lit("old").alias("lastUpdated"), F.lit(None).cast("array<float>").alias("embedding"))


def _parts_of(spark, d, high: int) -> DataFrame:
    """Relations of nations below a key to a region, as read from documents: one with no strength, one stronger, repeated words."""
    n = _t(spark, d, "nation").join(F.broadcast(_t(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey")).where(F.col("n_nationkey") < high)
    row = lambda no, said, strength: n.select(F.lit("Team").alias("src_type"), F.col("n_name").alias("src_name"), F.lit("Topic").alias("dst_type"), F.col("r_name").alias("dst_name"), F.lit("PART_OF").alias("relationship_type"), F.lit(said).alias("description"), F.lit(strength).cast("double").alias("strength"), F.lit("d").alias("item_id"), F.lit(no).alias("rel_no"), F.array(F.lit("a"), F.lit("b")).alias("sources"))
    return row(0, "lies in", None).unionByName(row(1, "belongs to", 5.0)).unionByName(row(2, "lies in", 3.0))


@query(f"WITH e AS ({_EDGES}) SELECT src_name, dst_name, CASE WHEN hit THEN 'PART_OF|lies in|belongs to' ELSE type END AS descriptions, CASE WHEN hit THEN 5.0 ELSE 2.0 END::DOUBLE AS strength, CASE WHEN hit THEN 'a|b' ELSE 'a' END AS sources, CASE WHEN hit THEN 'place|PART_OF' ELSE 'place|' || type END AS tags, 'old' AS created, CASE WHEN hit THEN 'new' ELSE 'old' END AS updated FROM (SELECT *, src_type = 'Team' AND src_name IN (SELECT n_name FROM nation WHERE n_nationkey < 10) AS hit FROM e)")
def upsert_relations(spark, d):
    out = relations.upsert_relations(_relations(spark, d), relations.consolidate(_parts_of(spark, d, 10)), F.lit("new"))
    return out.select("src_name", "dst_name", _joined("description").alias("descriptions"), "strength", _joined("sources").alias("sources"), _joined("relationTag").alias("tags"), F.col("createdAt").alias("created"), F.col("lastUpdated").alias("updated"))


@query("SELECT n_name AS src_name, n_nationkey < 10 AS embedded, n_nationkey >= 5 AS stored FROM nation WHERE n_nationkey >= 5 OR n_nationkey < 10")
def merged_relations_embedded(spark, d):
    old = _relations(spark, d).where("src_type = 'Team'").join(_t(spark, d, "nation").where("n_nationkey >= 5").select(F.col("n_name").alias("src_name")), "src_name", "left_semi")
    out = relations.consolidate_into(old, _parts_of(spark, d, 10), embed.HashingEmbedder(16), F.lit("new"))
    return out.select("src_name", (F.size("embedding") == 16).alias("embedded"), F.coalesce(F.col("createdAt") == "old", F.lit(False)).alias("stored")).select("src_name", F.coalesce("embedded", F.lit(False)).alias("embedded"), "stored")


@query(f"SELECT src_name, dst_name, CASE WHEN src_type = 'Team' THEN 'u' ELSE type END AS type, CASE WHEN src_type = 'Team' THEN 'a|z' ELSE 'a' END AS sources FROM ({_EDGES})")
def update_relations(spark, d):
    r = _relations(spark, d)
    u = r.where("src_type = 'Team'").select("relation_id", F.lit("u").alias("type"), F.array(F.lit("a"), F.lit("z")).alias("sources")).unionByName(spark.createDataFrame([("none", "x", ["q"])], "relation_id string, type string, sources array<string>"))
    return relations.update_relations(r, u).select("src_name", "dst_name", "type", _joined("sources").alias("sources"))


@query(f"SELECT src_name, dst_name FROM ({_EDGES}) WHERE src_type = 'Person'")
def delete_relations(spark, d):
    r = _relations(spark, d)
    return relations.delete_relations(r, r.where("src_type = 'Team'")).select("src_name", "dst_name")


@query(f"SELECT src_name, dst_name, src_type = 'Team' AND src_name < 'G' AS known FROM ({_EDGES}) WHERE src_type = 'Team'")
def relations_with_known_ends(spark, d):
    r = _edges(spark, d).where("src_type = 'Team'")
    nodes = _nodes(spark, d).where("type <> 'Team' or name < 'G'")
    good, bad = relations.with_known_ends(r, nodes)
    return good.withColumn("known", F.lit(True)).unionByName(bad.withColumn("known", F.lit(False))).select("src_name", "dst_name", "known")


@query(f"SELECT src_name, dst_name FROM ({_EDGES}) WHERE src_type = 'Team' AND src_name = (SELECT n_name FROM nation WHERE n_nationkey = 3)")
def relation_by_id(spark, d):
    r = _relations(spark, d)
    n = _t(spark, d, "nation").where("n_nationkey = 3").join(F.broadcast(_t(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey")).select(text.relation_id(F.col("n_name"), F.lit("PART_OF"), F.col("r_name")).alias("i")).first()["i"]
    return graph.GraphSession(spark, _nodes(spark, d).withColumn("permissions", F.array()), r).relation(n).select("src_name", "dst_name")


@query(f"SELECT src_name, dst_name, type FROM ({_EDGES}) WHERE src_type = 'Person' AND src_name = (SELECT min(c_name) FROM customer)")
def outgoing_edges(spark, d):
    first = _t(spark, d, "customer").agg(F.min("c_name")).first()[0]
    return graph.outgoing(_edges(spark, d), "Person", first, "place").select("src_name", "dst_name", "type")


@query(f"SELECT src_name, dst_name FROM ({_EDGES}) WHERE src_type = 'Team'")
def untagged_relations(spark, d):
    r = _relations(spark, d).withColumn("relationTag", F.when(F.col("src_type") == "Person", F.col("relationTag")).when(F.col("src_name") > "M", F.array().cast("array<string>")))
    return quality.untagged(r).select("src_name", "dst_name")


# -- nodes ----------------------------------------------------------------------------
def _full_nodes(spark, d) -> DataFrame:
    none = F.array().cast("array<string>")
    n = _nodes(spark, d)
    return n.withColumns({"emails": F.when(F.col("type") == "Person", F.array(F.concat("name", F.lit("@x")))).otherwise(none), "aliases": F.array(F.lower("name")), "rawDescriptions": F.array(F.lit("a"), F.lit("b")), "worksAt": F.when(F.col("type") == "Person", F.lit("")), "permissions": F.array(F.when(F.col("type") == "Team", "t").otherwise("o")), "sources": none, "embedding": F.lit(None).cast("array<float>")})


@query("SELECT c_name AS name FROM customer")
def persons_by_name(spark, d):
    return graph.GraphSession(spark, _full_nodes(spark, d), _relations(spark, d)).persons().select("name")


@query("SELECT 'Person' AS type, c_name AS name FROM customer WHERE c_name = (SELECT min(c_name) FROM customer)")
def node_by_email(spark, d):
    first = _t(spark, d, "customer").agg(F.min("c_name")).first()[0]
    return graph.with_email(_full_nodes(spark, d), f"{first}@x").select("type", "name")


@query("SELECT unnest(['type', 'name', 'emails', 'aliases', 'rawDescriptions', 'permissions']) AS field, unnest(['Person', x, x || '@x', lower(x), 'a, b', 'o']) AS value FROM (SELECT min(c_name) AS x FROM customer)")
def entity_details(spark, d):
    first = _t(spark, d, "customer").agg(F.min("c_name")).first()[0]
    return graph.GraphSession(spark, _full_nodes(spark, d), _relations(spark, d)).details(first, "Person")


@query(f"SELECT 'nodes of ' || type AS what, count(*) AS n FROM ({_NODES}) GROUP BY type UNION ALL SELECT 'relations', count(*) FROM ({_EDGES})")
def graph_statistics(spark, d):
    types, edges = graph.GraphSession(spark, _full_nodes(spark, d), _relations(spark, d)).stats()
    return types.select(F.concat(F.lit("nodes of "), F.col("type")).alias("what"), "n").unionByName(edges.select(F.lit("relations").alias("what"), F.col("relations").alias("n")))


@query("SELECT 'Team' AS type, n_name AS name FROM nation")
def permitted_nodes(spark, d):
    return graph.GraphSession(spark, _full_nodes(spark, d), _relations(spark, d), principal="t").nodes.select("type", "name")


@query("SELECT * FROM (VALUES (1, 'text'), (2, 'rows'), (3, 'text'), (4, 'rows'), (5, 'rows'), (6, 'error')) t(line, said)")
def interactive_session(spark, d):
    said = []
    s = graph.GraphSession(spark, _full_nodes(spark, d), _relations(spark, d))

    def show(x):
        said.append("rows" if isinstance(x, DataFrame) else "error" if "Error" in x or "Exception" in x else "text")

    s.search = lambda *a: 1 // 0
    graph.interactive(s, ["help", "details x Person", "", "stats", "boom", "exit", "stats"], show)
    return _rows(spark, list(enumerate(said, 1)), "line int, said string")


# -- stores ---------------------------------------------------------------------------
@query("SELECT * FROM (VALUES (1, 'missing', '', 0, 0), (2, 'init', 'nodes,relations', 0, 0), (3, 'filled', 'nodes,relations', 25, 25), (4, 'nodes again', 'nodes,relations', 20, 25), (5, 'cleared', 'nodes,relations', 0, 0), (6, 'migrated', 'nodes,relations', 0, 0), (7, 'dropped', '', 0, 0)) t(step, what, tables, nodes, relations)")
def store_lifecycle(spark, d):
    store = GraphStore(spark, folder(spark))
    rows = []

    def note(what):
        rows.append((len(rows) + 1, what, ",".join(store.list_tables()), store.read("nodes").count(), store.read("relations").count()))

    teams, r = _full_nodes(spark, d).where("type = 'Team'"), _relations(spark, d).where("src_type = 'Team'")
    note("missing")
    store.create()
    note("init")
    store.commit(nodes=teams, relations=r)
    note("filled")
    store.commit(nodes=store.read("nodes").join(_t(spark, d, "nation").where("n_nationkey >= 5").select(F.col("n_name").alias("name")), "name", "left_semi"))
    note("nodes again")
    store.clean()
    note("cleared")
    store.migrate()
    note("migrated")
    store.drop()
    note("dropped")
    return _rows(spark, rows, "step int, what string, tables string, nodes int, relations int")


@query("SELECT t.type, count(n.n_name) AS n FROM (VALUES ('Person'),('Team'),('Organization'),('Project'),('Repository'),('Branch'),('CodeChangeRequest'),('Issue'),('Event'),('Topic')) t(type) LEFT JOIN nation n ON t.type = 'Team' GROUP BY 1 UNION ALL SELECT 'Relation', count(*) FROM nation")
def store_info(spark, d):
    store = GraphStore(spark, folder(spark))
    store.commit(nodes=_full_nodes(spark, d).where("type = 'Team'"), relations=_relations(spark, d).where("src_type = 'Team'"))
    return store.info()


@query("SELECT * FROM (VALUES ('nodes', true), ('relations', true)) t(tab, has_fields)")
def schema_backup(spark, d):
    at = f"{folder(spark)}/schema.json"
    GraphStore(spark, folder(spark)).backup_schema(at)
    v = spark.read.text(at, wholetext=True).select(F.explode(F.from_json("value", "map<string,struct<fields:array<struct<name:string>>>>")).alias("tab", "s"))
    return v.select("tab", (F.size("s.fields") > 10).alias("has_fields"))


@query("SELECT * FROM (VALUES ('embedder', true), ('failing embedder', false), ('missing server', false), ('store', true)) t(what, works)")
def connectivity_probes(spark, d):
    class Broken:
        dim = 2

        def embed(self, texts):
            raise OSError("no model")

    away = sources.VisitReader({"url": "http://127.0.0.1:9", "retries": "1", "timeout": "1"})
    return _rows(spark, [("embedder", embed.works(embed.HashingEmbedder(8))), ("failing embedder", embed.works(Broken())), ("missing server", away.works()), ("store", GraphStore(spark, folder(spark)).works())], "what string, works boolean")


# -- batches and runs -----------------------------------------------------------------
def _batch_files(spark, d) -> str:
    """A file for each region: results of its nations (odd regions) or one batch (even ones); suppliers are persons at their nation."""
    at = folder(spark)
    n = _t(spark, d, "nation").join(F.broadcast(_t(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    entity = lambda name, kind, **a: F.struct(name.alias("entity_name"), F.lit(kind).alias("entity_type"), F.struct(*[v.alias(k) for k, v in a.items()]).alias("attributes"))
    team = entity(F.col("n_name"), "Team", description=F.concat(F.lit("in "), F.col("r_name")), aliases=F.array(F.lower("n_name")))
    topic = F.struct(F.upper("r_name").alias("entity_name"), F.lit("Topic").alias("entity_type"), F.struct(F.lit("a region").alias("description"), F.array().cast("array<string>").alias("aliases")).alias("attributes"))
    rel = F.struct(F.col("n_name").alias("source_entity"), F.col("r_name").alias("target_entity"), F.lit("PART_OF").alias("relationship_type"), F.lit("lies in").alias("description"), F.lit(7).alias("strength"))
    lost = F.struct(F.col("n_name").alias("source_entity"), F.lit("nobody").alias("target_entity"), F.lit("KNOWS").alias("relationship_type"), F.lit("x").alias("description"), F.lit(1).alias("strength"))
    one = n.groupBy("r_regionkey", "r_name").agg(F.collect_list(F.struct(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("item_id"), F.array(team, topic).alias("entities"), F.array(rel, lost).alias("relationships"))).alias("results"))
    flat = F.struct(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("source_item_id"), F.flatten(F.transform("results", lambda x: x["entities"])).alias("entities"), F.flatten(F.transform("results", lambda x: x["relationships"])).alias("relations"))
    made = one.select("r_regionkey", F.when(F.col("r_regionkey") % 2 == 1, F.to_json(F.struct("results"))).otherwise(F.to_json(flat)).alias("value"))
    made.unionByName(spark.createDataFrame([(99, '{"neither": 1}')], "r_regionkey int, value string")).repartition(8, "r_regionkey").write.partitionBy("r_regionkey").text(at)
    return at


def _files(df: DataFrame) -> DataFrame:
    return df.withColumn("region", F.regexp_extract("file", r"r_regionkey=(\d+)", 1))


@query("SELECT CASE WHEN n_regionkey % 2 = 1 THEN 'n' || n_nationkey ELSE 'r' || n_regionkey END AS item_id, n_name AS name, 'Team' AS type, 'in ' || r_name AS said, lower(n_name) AS aliases, 'aliases|sources' AS lists FROM nation JOIN region ON r_regionkey = n_regionkey UNION ALL SELECT CASE WHEN n_regionkey % 2 = 1 THEN 'n' || n_nationkey ELSE 'r' || n_regionkey END, upper(r_name), 'Topic', 'a region', '', 'aliases|sources' FROM nation JOIN region ON r_regionkey = n_regionkey")
def batch_file_entities(spark, d):
    e = sources.batch_entities(sources.read_batches(spark, _batch_files(spark, d), "*.txt"))
    a = lambda k: F.col("attributes")[k]
    return e.select("item_id", F.col("entity_name").alias("name"), F.col("entity_type").alias("type"), a("description")[0].alias("said"), _joined(a("aliases")).alias("aliases"), F.array_join(F.array_sort("list_keys"), "|").alias("lists"))


@query("SELECT CASE WHEN n_regionkey % 2 = 1 THEN 'n' || n_nationkey ELSE 'r' || n_regionkey END AS item_id, n_name AS src, dst, type, strength, CASE WHEN n_regionkey % 2 = 1 THEN 'n' || n_nationkey ELSE 'r' || n_regionkey END AS sources FROM nation JOIN region ON r_regionkey = n_regionkey, LATERAL (VALUES (r_name, 'PART_OF', 7.0::DOUBLE), ('nobody', 'KNOWS', 1.0::DOUBLE)) t(dst, type, strength)")
def batch_file_relations(spark, d):
    r = sources.batch_relations(sources.read_batches(spark, _batch_files(spark, d), "*.txt"))
    return r.select("item_id", F.col("source_entity").alias("src"), F.col("target_entity").alias("dst"), F.col("relationship_type").alias("type"), "strength", _joined("sources").alias("sources"))


@query("SELECT 'Team' AS type, n_name AS name, 'in ' || r_name AS descriptions, CASE WHEN n_regionkey % 2 = 1 THEN 'n' || n_nationkey ELSE 'r' || n_regionkey END AS sources FROM nation JOIN region ON r_regionkey = n_regionkey UNION ALL SELECT 'Topic', upper(r_name), 'a region', string_agg(DISTINCT CASE WHEN n_regionkey % 2 = 1 THEN 'n' || n_nationkey ELSE 'r' || n_regionkey END, '|' ORDER BY CASE WHEN n_regionkey % 2 = 1 THEN 'n' || n_nationkey ELSE 'r' || n_regionkey END) FROM nation JOIN region ON r_regionkey = n_regionkey GROUP BY r_name")
def merge_batch_files(spark, d):
    """Two merges of the same files: the second changes nothing."""
    store, at = GraphStore(spark, folder(spark)), _batch_files(spark, d)
    for _ in range(2):
        pipeline.merge_files(spark, at, store, F.lit(NOW), "*.txt", embed.HashingEmbedder(8))
    return store.read("nodes").select("type", "name", _joined("rawDescriptions").alias("descriptions"), F.array_join(F.array_sort("sources"), "|").alias("sources"))


@query("SELECT r_regionkey::VARCHAR AS region, CASE WHEN r_regionkey % 2 = 1 THEN count(*) ELSE 1 END AS documents, 2 * count(*) AS entities, count(*) - 1 AS merged, 2 * count(*) AS relations, count(*) AS rejected, 0::BIGINT AS errors FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY r_regionkey UNION ALL SELECT '99', 0, 0, 0, 0, 0, 1")
def merge_batch_statistics(spark, d):
    store = GraphStore(spark, folder(spark))
    return _files(pipeline.merge_files(spark, _batch_files(spark, d), store, F.lit(NOW), "*.txt", embed.HashingEmbedder(8))).drop("file")


def _mails(spark, d) -> DataFrame:
    """A text for each supplier that names an address at its nation; odd ones may be read by p1; every seventh is empty."""
    s = _t(spark, d, "supplier").join(F.broadcast(_t(spark, d, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    said = F.concat(F.lit("write to u"), F.col("s_suppkey").cast("string"), F.lit("@n"), F.col("n_nationkey").cast("string"), F.lit(".org today"))
    k = F.col("s_suppkey")
    return s.select(k.cast("string").alias("id"), F.when(k % 7 == 0, " ").otherwise(said).alias("text"), F.concat(F.lit("s"), (k % 3).cast("string")).alias("source"), F.when(k % 2 == 1, F.array(F.lit("p1"))).otherwise(F.array().cast("array<string>")).alias("permissions"))


_MAILED = "SELECT s_suppkey AS k, 'u' || s_suppkey AS who, 'n' || s_nationkey || '.org' AS org, 's' || s_suppkey % 3 AS src FROM supplier WHERE s_suppkey % 7 <> 0"


@query(f"WITH m AS ({_MAILED}) SELECT 'node' AS kind, 'Person' AS type, who AS name FROM m WHERE k % 2 = 1 UNION ALL SELECT DISTINCT 'node', 'Organization', org FROM m WHERE k % 2 = 1 UNION ALL SELECT DISTINCT 'node', 'Topic', src FROM m WHERE k % 2 = 1 UNION ALL SELECT 'edge', 'WORKS_AT', who FROM m WHERE k % 2 = 1 UNION ALL SELECT 'edge', 'MENTIONED_IN', who FROM m WHERE k % 2 = 1")
def permissions_reach_graph(spark, d):
    """Documents with permissions, ingested and read back by a principal."""
    store = GraphStore(spark, folder(spark))
    pipeline.ingest(spark, _mails(spark, d), store, F.lit(NOW), embedder=embed.HashingEmbedder(8))
    s = graph.GraphSession(spark, store.read("nodes"), store.read("relations"), principal="p1")
    return s.nodes.select(F.lit("node").alias("kind"), "type", "name").unionByName(s.relations.select(F.lit("edge").alias("kind"), "type", F.col("src_name").alias("name")))


def _log(spark, d, at: str) -> streaming.Progress:
    p = streaming.Progress(spark, at)
    e = _t(spark, d, "events")
    kind = F.when(F.col("event_type") == "purchase", "processed").when(F.col("event_type") == "error", "failed")
    p.append(e.select(F.col("user_id").cast("string").alias("item_id"), kind.alias("status"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), F.concat(F.lit("s"), (F.col("event_id") % 3).cast("string")).alias("session_id"), F.lit(2).alias("entity_count"), F.lit(1).alias("relationship_count"), F.lit(None).cast("string").alias("error")).where("status is not null"))
    return p


_LOG = "SELECT user_id::VARCHAR AS item_id, CASE WHEN event_type = 'purchase' THEN 'processed' ELSE 'failed' END AS status, ts, event_id FROM events WHERE event_type IN ('purchase', 'error')"


@query(f"SELECT 's' || event_id % 3 AS session_id, count(*) FILTER (status = 'processed') AS processed, count(*) FILTER (status = 'failed') AS failed, (2 * count(*))::BIGINT AS entities, count(*) AS relationships FROM ({_LOG}) GROUP BY 1")
def progress_sessions(spark, d):
    return _log(spark, d, folder(spark)).sessions().select("session_id", "processed", "failed", "entities", "relationships")


@query(f"WITH l AS (SELECT item_id, bool_or(status = 'processed') AS ok FROM ({_LOG}) GROUP BY 1) SELECT count(*) FILTER (ok) AS processed, count(*) FILTER (NOT ok) AS failed, (SELECT count(*) FROM l WHERE ok) AS after_reset, 0::BIGINT AS failed_after_reset FROM l")
def progress_summary_and_reset(spark, d):
    p = _log(spark, d, folder(spark))
    before = p.summary().first()
    p.reset_failed("2099")
    after = p.summary().first()
    return _rows(spark, [(before["processed"], before["failed"], after["processed"], after["failed"])], "processed long, failed long, after_reset long, failed_after_reset long")


@query(f"SELECT DISTINCT user_id::VARCHAR AS id FROM events WHERE user_id::VARCHAR NOT IN (SELECT item_id FROM ({_LOG}) WHERE status = 'processed')")
def unprocessed_documents(spark, d):
    docs = _t(spark, d, "events").select(F.col("user_id").cast("string").alias("id")).distinct().unionByName(spark.createDataFrame([("",), (None,)], "id string"))
    return _log(spark, d, folder(spark)).unprocessed(docs)


@query(f"SELECT count(*) FILTER (k % 7 <> 0) AS processed, count(*) FILTER (k % 7 = 0) AS failed, (3 * count(*) FILTER (k % 7 <> 0))::BIGINT AS entities, (2 * count(*) FILTER (k % 7 <> 0))::BIGINT AS relationships, (SELECT count(DISTINCT who) + count(DISTINCT org) + count(DISTINCT src) FROM ({_MAILED})) AS nodes, 0::BIGINT AS left_over FROM (SELECT s_suppkey AS k FROM supplier)")
def pipeline_run(spark, d):
    """A session over documents that are not processed; a second one has the failed ones only."""
    at = folder(spark)
    store, p = GraphStore(spark, f"{at}/g"), streaming.Progress(spark, f"{at}/p")
    docs = _mails(spark, d)
    s = streaming.run(spark, docs, store, p, "one", F.lit(NOW), results=f"{at}/o").first()
    saved = spark.read.schema("item_id string, status string").json(f"{at}/o/run=one").count()
    left = p.unprocessed(docs).count() - s["failed"]
    return _rows(spark, [(s["processed"], saved - s["processed"], s["entities"], s["relationships"], store.read("nodes").count(), left)], "processed long, failed long, entities long, relationships long, nodes long, left_over long")


@query(f"SELECT count(*) FILTER (k % 7 <> 0) AS processed, count(*) FILTER (k % 7 = 0) AS failed, (SELECT count(DISTINCT who) + count(DISTINCT org) + count(DISTINCT src) FROM ({_MAILED})) AS nodes, (SELECT 2 * count(*) FROM ({_MAILED})) AS relations FROM (SELECT s_suppkey AS k FROM supplier)")
def stream_ingest(spark, d):
    """The same documents as a stream of files in micro-batches, with what is there when it starts."""
    at = folder(spark)
    docs = _mails(spark, d)
    docs.repartition(2, "id").write.parquet(f"{at}/in")
    store, p = GraphStore(spark, f"{at}/g"), streaming.Progress(spark, f"{at}/p")
    source = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(f"{at}/in")
    streaming.stream(spark, source, store, p, f"{at}/cp", F.lit(NOW)).awaitTermination()
    s = p.summary().first()
    return _rows(spark, [(s["processed"], s["failed"], store.read("nodes").count(), store.read("relations").count())], "processed long, failed long, nodes long, relations long")
