"""The graph engine: grammar, resolution, merging, storage, streaming and the query catalogue."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from entityflow import cli
from entityflow.config import RULES, Config
from entityflow.functions import embed, extract, parse, text
from entityflow.operators import graph, match, merge
from entityflow.operators.components import connected_components
from entityflow.plans import catalog
from entityflow.plans.pipeline import ingest
from entityflow.schema import GraphStore, nodes_schema, separate, spark_type, unify
from entityflow.sources import documents, sinks
from entityflow.streaming.ingest import Progress, process, stream

SF = "/root/testdata/sf0.001"


@pytest.fixture
def save(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path / "cp"))
    return lambda df: df.checkpoint()


def test_grammar(spark):
    raw = 'prose\n("entity"<|>"Ann Lee"<|>Person<|>"email": "a@x.org"<|>"aliases": "[Ann, "<|>"role": "[]"<|>"bad"<|>"email": "b@x.org")##\nwrapped line\n("entity"<|>two parts)##\n("relationship"<|>A<|>B<|>KNOWS<|>"since: 2001"<|>-7.5 or so)##\n("relationship"<|>A<|>B<|>KNOWS<|>d<|>none)##\n<|COMPLETE|>'
    df = parse.parsed(spark.createDataFrame([("d1", raw), ("d2", None), ("d3", "nothing here")], "item_id string, raw_output string"))
    e = parse.entity_items(df).collect()
    assert len(e) == 1 and e[0]["entity_name"] == "Ann Lee" and e[0]["attributes"]["email"] == ["b@x.org"] and e[0]["attributes"]["aliases"] == ["[Ann, "]
    assert e[0]["attributes"]["role"] == [] and e[0]["attributes"]["sources"] == ["d1"] and e[0]["attributes"]["name"] == ["Ann Lee"]
    assert [(r["strength"], r["description"]) for r in parse.relation_items(df).collect()] == [(7.5, "since: 2001"), (5.0, "d")]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=25))
def test_components(spark, tmp_path_factory, edges):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("cp")))
    par = {}

    def find(a):
        while par[a] != a:
            a = par[a]
        return a

    for a, b in edges:
        par.setdefault(a, a), par.setdefault(b, b)
        x, y = find(a), find(b)
        par[max(x, y)] = min(x, y)
    got = connected_components(spark.createDataFrame(edges, "src int, dst int"), lambda d: d.checkpoint())
    assert {(r["node"], r["component"]) for r in got.collect()} == {(a, find(a)) for a in par}


def _items(spark, rows):
    return spark.createDataFrame([(u, t, n, a, ls, u) for u, t, n, a, ls in rows], "uid int, entity_type string, entity_name string, attributes map<string,array<string>>, list_keys array<string>, ord int")


def test_rules(spark, save):
    it = _items(spark, [(1, "Person", "Ann", {"email": ["A@x.org "]}, []), (2, "Person", "A. Lee", {"email": ["a@x.org"]}, []), (3, "Person", "Bo", {"aliases": ["ann", ""]}, ["aliases"]), (4, "Person", "Cy", {"aliases": [""]}, ["aliases"]), (5, "Team", "Ann", {}, []), (6, "Widget", " ann", {}, []), (7, "Widget", "ANN", {}, [])])
    got = {r["uid"]: r["cluster"] for r in match.resolve(it, RULES, save).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6, 7: 6}
    strict = {r["uid"]: r["cluster"] for r in match.resolve(it, RULES, save, strict=True).collect()}
    assert strict[2] == 2 and strict[1] == 1 and strict[3] == 3


def test_cluster_merge(spark):
    it = _items(spark, [(1, "Person", "Ann", {"email": ["a"], "description": ["d1"], "worksAt": [""]}, []), (2, "Person", "Annie", {"email": ["b", "a"], "worksAt": ["X"], "nosuch": ["q"]}, ["email"])]).withColumn("cluster", F.lit(1))
    n = merge.clusters_to_nodes(it).first()
    assert (n["name"], n["emails"], n["aliases"], n["rawDescriptions"], n["worksAt"]) == ("Ann", ["a", "b"], ["Annie"], ["d1"], "X")


def test_ingest_is_idempotent(spark, tmp_path):
    docs = spark.createDataFrame([("1", "write to ann@acme.org and bo@acme.org", "news"), ("2", "ann@acme.org again", "blog"), ("3", "  ", "x")], "id string, text string, source string")
    store = GraphStore(spark, str(tmp_path / "g"))
    now = F.lit("2024-01-01T00:00:00")
    status = {r["item_id"]: r["status"] for r in ingest(spark, docs, store, now).collect()}
    assert status == {"1": "processed", "2": "processed", "3": "failed"}
    dump = lambda: [sorted(map(str, store.read(t).drop("embedding").collect())) for t in store.TABLES]
    first = dump()
    assert store.version("nodes") == 1 and len(first[1]) == 5
    ingest(spark, docs, store, now).collect()
    assert dump() == first
    names = {(r["type"], r["name"]) for r in store.read("nodes").collect()}
    assert names == {("Person", "ann"), ("Person", "bo"), ("Organization", "acme.org"), ("Topic", "news"), ("Topic", "blog")}
    s = graph.GraphSession(spark, store.read("nodes"), store.read("relations"))
    assert s.run("details ann Person").where("field = 'emails'").first()["value"] == "ann@acme.org"
    assert s.run("relations acme.org Organization").count() == 2 and s.search("ann", 99).count() == 5 and s.run("stats")[1].first()[0] == 5
    assert s.sql("SELECT * FROM nodes WHERE name = :n", n="bo").count() == 1 and s.persons().count() == 2
    assert graph.GraphSession(spark, store.read("nodes"), store.read("relations"), principal="nobody").persons().count() == 0
    assert {r["type"]: r["n"] for r in store.info().collect()}["Branch"] == 0


def test_progress_and_stream(spark, tmp_path):
    d = spark.createDataFrame([("1", "a@b.org", "s"), ("2", "", "s")], "id string, text string, source string")
    d.write.parquet(str(tmp_path / "in"))
    store, progress = GraphStore(spark, str(tmp_path / "g")), Progress(spark, str(tmp_path / "p"))
    now = F.lit("2024-01-01")
    q = stream(spark, spark.readStream.schema(d.schema).parquet(str(tmp_path / "in")), store, progress, str(tmp_path / "cp"), now)
    q.awaitTermination(120)
    assert [tuple(r)[:2] for r in progress.summary().collect()] == [(1, 1)] and store.read("nodes").count() == 3
    assert [r["id"] for r in progress.unprocessed(d).collect()] == ["2"]
    process(spark, d, store, progress, "again", now)
    progress.reset_failed("2025")
    assert progress.summary().first()["failed"] == 0


def test_schema(spark, tmp_path, capsys):
    assert len(nodes_schema()) == 40 or len(nodes_schema()) == 41
    ent, rel = separate({"A": {"name": "STRING PRIMARY KEY", "x": "STRING[]"}, "B": {"x": "STRING", "e": "FLOAT[8]", "f": "ANY"}})
    assert unify(ent).fieldNames() == ["type", "name", "x", "e"] and "strength" in rel and spark_type("ANY") is None
    base = str(tmp_path / "g")
    for argv in (["init"], ["status"], ["schema"], ["clear"], ["migrate"], ["backup", str(tmp_path / "s.json")]):
        assert cli.main(["--base", base, *argv], spark) == 0
    assert set(json.load(open(tmp_path / "s.json"))) == {"nodes", "relations"} and cli.main([]) == 1
    store = GraphStore(spark, base)
    assert store.list_tables() == ["nodes", "relations"]
    store.drop()
    assert store.list_tables() == [] and Config().target("Person", "email") == "emails"


def test_sources(spark, tmp_path):
    visit = ['{"id":"1","fields":{"subject":"S","chunks":["a","b"],"to":"x","cc":["y","z"],"timestamp":1704067200000,"extra":"k"}}', '{"fields":{"docId":"2","chunks":"whole","timestamp":"2024-01-01T00:00:00"}}', '{"fields":{}}', "junk"]
    got = {r["id"]: r for r in documents.parse_visit(spark.createDataFrame([(v,) for v in visit], "value string")).collect()}
    assert set(got) == {"1", "2"} and got["1"]["content"] == "a b" and got["1"]["to"] == ["x"] and got["1"]["cc"] == ["y", "z"] and got["1"]["metadata"] == {"extra": "k"}
    assert got["1"]["timestamp"] == got["2"]["timestamp"] and got["2"]["title"] == "No subject" and got["2"]["content"] == "whole"
    hit = documents.parse_hit(spark.createDataFrame([('{"id":"h","fields":{"subject":"S","body":"B","from":"F"}}',)], "value string")).first()
    assert (hit["title"], hit["content"], hit["source"]) == ("S", "B", "F")
    (tmp_path / "d.json").write_text('{"documents":[{"id":"1","title":"t"},{"title":"no id"}]}')
    (tmp_path / "d.jsonl").write_text('{"id":"1","title":"t"}\n\nbroken{\n')
    assert documents.read_json_documents(spark, str(tmp_path / "d.json")).count() == 1 and documents.read_json_lines(spark, str(tmp_path / "d.jsonl")).count() == 1
    (tmp_path / "b").mkdir()
    (tmp_path / "b/x.json").write_text('{"results":[{"item_id":"i","entities":[{"a":1}],"relationships":[]}]}')
    (tmp_path / "b/y.json").write_text('{"entities":[{"a":1},{"a":2}],"relations":[],"source_item_id":"j"}')
    assert {(r["item_id"], len(r["entities"])) for r in documents.read_batches(spark, str(tmp_path / "b")).collect()} == {("i", 1), ("j", 2)}
    docs = spark.createDataFrame([("1", "a", "x"), ("2", "a", "y"), ("3", "b", "z")], "id string, doc_type string, title string")
    stats = {r["doc_type"]: (r["n"], r["status"]) for r in sinks.export_by_type(docs, ["a", "c"], str(tmp_path / "e"), 1).collect()}
    assert stats == {"a": (1, "exported"), "c": (0, "no documents")}
    assert sinks.export_json(docs, str(tmp_path / "j"), "now").first()["total_documents"] == 3


def test_visit_source(spark):
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer
    from urllib.parse import parse_qs, urlparse

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            q = parse_qs(urlparse(self.path).query)
            page = {"documents": [{"id": "b"}]} if "continuation" in q else {"documents": [{"id": "a"}], "continuation": "t&1"}
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps(page).encode())

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    spark.dataSource.register(documents.VisitSource)
    got = spark.read.format("visit").option("url", f"http://127.0.0.1:{server.server_port}/visit").load().collect()
    server.shutdown()
    assert sorted(json.loads(r["value"])["id"] for r in got) == ["a", "b"]


def test_functions(spark):
    row = spark.createDataFrame([(" Ab ", ["x", "x"], ["y", "x"])], "s string, a array<string>, b array<string>")
    got = row.select(text.normalise(F.col("s")).alias("n"), text.append_unique(F.col("a"), F.col("b")).alias("u"), text.similarity_percent(F.lit("x")).alias("p"), text.relation_text(F.array().cast("array<string>"), F.lit(""), F.array().cast("array<string>"), F.lit(None).cast("double")).alias("r"), text.fallback_name(F.lit(""), F.lit(None).cast("string"), F.lit("me@x")).alias("f"), text.sequence_ratio(F.lit("abcd"), F.lit("bcde")).alias("q")).first()
    assert tuple(got) == ("ab", ["x", "x", "y"], 0.0, "Generic relation", "User_me", 0.75)
    v = embed.HashingEmbedder(64).embed(["a b", "a b", "zz"])
    assert (v[0] == v[1]).all() and abs((v[2] ** 2).sum() - 1) < 1e-5
    assert row.select(embed.embed(F.lit("")).alias("e")).first()["e"] is None


def test_extractor_plugin(spark):
    class Upper:
        def extract(self, texts):
            if "boom" in texts:
                raise ValueError("no")
            return [t.upper() for t in texts]

    docs = spark.createDataFrame([("1", "a"), ("2", " ")], "item_id string, text string")
    assert [tuple(r) for r in extract.extract_with(docs, Upper()).orderBy("item_id").collect()] == [("1", "A", None), ("2", None, "empty content")]
    assert "ValueError" in extract.extract_with(docs.withColumn("text", F.lit("boom")), Upper()).first()["error"]
    assert "Person" in extract.prompt()


def test_store_commits_both_tables_and_forgets_old_ones(spark, tmp_path):
    import os

    base = str(tmp_path / "g")
    store = GraphStore(spark, base)
    assert store.works() and store.read("nodes").count() == 0 and store.version("nodes") is None
    store.create()
    node = lambda n: spark.createDataFrame([("Team", f"t{i}") for i in range(n)], "type string, name string")
    before = store.read("nodes")
    for i in range(1, 4):
        store.commit(nodes=node(i))
    assert store.version("nodes") == 3 and store.version("relations") == 0 and store.read("nodes").count() == 3
    assert sorted(x[:4] for x in os.listdir(f"{base}/nodes") if x.startswith("v=")) == ["v=2-", "v=3-"] and sorted(x for x in os.listdir(f"{base}/_log") if x.isdigit()) == ["0000000002", "0000000003"]
    assert before.schema == store.read("nodes").schema
    other = GraphStore(spark, base)
    log = other.log()
    other.log = lambda: log  # a writer that has not seen the next commit
    store.commit(nodes=node(5))
    with pytest.raises(RuntimeError):
        other.commit(nodes=node(7))
    assert store.read("nodes").count() == 5 and not [x for x in os.listdir(f"{base}/_log") if x.startswith("_draft")]


def test_ingest_leaves_no_scratch_and_embeds_relations(spark, tmp_path):
    import os

    base = str(tmp_path / "g")
    store = GraphStore(spark, base)
    docs = spark.createDataFrame([("1", "ann@acme.org", "news", ["p"]), ("2", "bo@acme.org", "news", []), ("3", None, "news", ["q"])], "id string, text string, source string, permissions array<string>")
    status = ingest(spark, docs, store, F.lit("2024"), embedder=embed.HashingEmbedder(8))
    assert status.count() == 3 and not os.listdir(f"{base}/_work")
    r = {x["src_name"]: x for x in store.read("relations").where("type = 'WORKS_AT'").collect()}
    assert len(r["ann"]["embedding"]) == 8 and r["ann"]["permissions"] == ["p"] and r["bo"]["permissions"] == []
    n = {(x["type"], x["name"]): x["permissions"] for x in store.read("nodes").collect()}
    assert n["Person", "ann"] == ["p"] and n["Person", "bo"] == [] and n["Organization", "acme.org"] == ["p"]


def test_commands_of_the_command_line(spark, tmp_path, capsys, monkeypatch):
    import io
    import sys

    base = str(tmp_path / "g")
    (tmp_path / "b").mkdir()
    (tmp_path / "b/x.json").write_text(json.dumps({"results": [{"item_id": "i", "entities": [{"entity_name": "Ann", "entity_type": "Person", "attributes": {"email": "ann@x.org", "role": ["a", "b"], "worksAt": 5, "none": None}}, {"entity_type": "Person"}], "relationships": [{"source_entity": "Ann", "target_entity": " ANN ", "relationship_type": "IS"}, {"source_entity": "Ann"}]}]}, indent=2))
    (tmp_path / "b/y.json").write_text("[]")
    (tmp_path / "d.json").write_text(json.dumps({"documents": [{"id": "1", "title": "t", "content": "bo@acme.org", "source": "s"}, {"id": "2", "title": " ", "content": " ", "source": "s"}]}))
    run = lambda *a: (cli.main(["--base", base, *a], spark), capsys.readouterr().out)
    assert run("test") == (0, "reached\n")
    code, out = run("merge", str(tmp_path / "b/x.json"))
    assert code == 0 and "Person" in out
    assert run("merge", str(tmp_path / "b"))[0] == 1  # one file is no batch
    assert "ann@x.org" in run("persons")[1]
    ann = GraphStore(spark, base).read("nodes").where("name = 'Ann'").first()
    assert (ann["emails"], ann["role"], ann["worksAt"], ann["sources"]) == (["ann@x.org"], ["a", "b"], "5", ["i"]) and GraphStore(spark, base).read("relations").count() == 1
    assert run("run", str(tmp_path / "d.json"), "--max", "5")[0] == 0
    assert "50.0" in run("progress")[1] and run("reset") == (0, "1 failed documents are new again\n") and "100.0" in run("progress")[1]
    monkeypatch.setattr(sys, "stdin", io.StringIO("help\nstats\nexit\n"))
    code, out = run("interactive")
    assert code == 0 and "relations" in out and "Topic" in out
    monkeypatch.setenv("ENTITYFLOW_PAGE_SIZE", "0")
    with pytest.raises(ValueError):
        run("status")


def test_configuration_files(tmp_path):
    (tmp_path / "c.yaml").write_text("""
entity_schemas:
  Ship:
    llm_fields: [name, flag, note]
    mappings:
      name: {type: "STRING PRIMARY KEY", merge_strategy: preserve_existing, mapping: name}
      flags: {type: "STRING[]", merge_strategy: append_unique, mapping: flag}
      rawDescriptions: {type: "STRING[]", mapping: note}
      port: {type: STRING, merge_strategy: replace_always, mapping: port}
      embedding: {type: "DOUBLE[]", mapping: embedding}
systematic_merge:
  matching_rules:
    Ship:
      - {rule: search, match: flag, db: flags, type: list, priority: 2, confidence: 0.7}
      - {rule: exact, match: name, priority: 1, confidence: 0.9}
""")
    c = Config.from_yaml(str(tmp_path / "c.yaml"))
    assert c.entity_types() == ["Ship"] and "port" in c.scalars("Ship") and "flags" in c.arrays("Ship") and c.target("Ship", "flag") == "flags" and c.target("Ship", "note") == "rawDescriptions"
    assert c.strategy("Ship", "port") == "replace_always" and [(r.kind, r.match, r.db) for r in c.rules_of("Ship")] == [("exact", "name", "name"), ("search", "flag", "flags")] and c.prompt_fields["Ship"] == ("name", "flag", "note")


def test_prompts_and_chat_extractor(spark):
    assert len({extract.prompt(data_type=t) for t in text.DATA_TYPES}) == 5 and "Team" not in extract.prompt(entity_types=["Person"]) and "Widget" in extract.extraction_prompt("x", entity_types=["Widget"])

    def call(system, user):
        if "boom" in user:
            raise OSError("away")
        return user[-3:] + str(len(system) > 100)

    assert extract.ChatExtractor(call, data_type="chat").extract(["a", "boom"]) == ["|>:True", ""] or extract.ChatExtractor(call).extract(["boom"]) == [""]


def test_visit_source_gives_up_on_wrong_requests(monkeypatch):
    from urllib import request
    from urllib.error import HTTPError

    tries = []

    def answer(url, timeout):
        tries.append(url)
        raise HTTPError(url, 404 if len(tries) == 1 else 503, "no", {}, None)

    monkeypatch.setattr(request, "urlopen", answer)
    monkeypatch.setattr("time.sleep", lambda s: None)
    reader = documents.VisitReader({"url": "http://x", "retries": "3"})
    assert not reader.works() and len(tries) == 1
    assert not reader.works() and len(tries) == 4


@pytest.mark.parametrize("line,want", [("details Ann Lee Person", ("details", ("Ann Lee", "Person"))), ("top 99 graph db", ("search", ("graph db", 50))), ("top x y", ("search", ("top x y", 10))), ("stats", ("stats", ())), ("quit", ("exit", ())), ("", ("help", ())), ("who is it", ("search", ("who is it", 10)))])
def test_commands(line, want):
    assert graph.parse_command(line) == want


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_queries_equal_sql(spark, name):
    import duckdb

    df = catalog.QUERIES[name](spark, SF)
    rows = df.collect()
    if name not in catalog.ORACLES:
        assert rows
        return
    c = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "labels", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = c.execute(catalog.ORACLES[name])
    names = [x[0] for x in cur.description]
    want = cur.fetchall()
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    assert sorted(str(tuple(r[k] for k in order)) for r in rows) == sorted(str(tuple(r[names.index(k)] for k in order)) for r in want)
