"""Readers and normalisation of mail-like documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from entityflow.functions.text import prepared_text, timestamp

DOCUMENT = "id string, title string, content string, doc_type string, timestamp string, metadata map<string,string>, source string"
_KNOWN = ("docId", "subject", "chunks", "from", "to", "cc", "bcc", "timestamp", "title", "content", "body", "source", "doc_type", "id")


def _text(fields: Column, key: str) -> Column:
    return F.try_variant_get(fields, f"$.{key}", "string")


def _list(fields: Column, key: str) -> Column:
    """Array as it is, scalar as a list of one, null and empty as no elements."""
    many = F.try_variant_get(fields, f"$.{key}", "array<string>")
    one = _text(fields, key)
    return F.coalesce(many, F.when(one.isNotNull() & (one != ""), F.array(one)), F.array().cast("array<string>"))


def _rest(json: Column) -> Column:
    return F.map_filter(F.coalesce(F.from_json(json, "map<string,string>"), F.create_map().cast("map<string,string>")), lambda k, v: ~k.isin(*_KNOWN))


def parse_visit(df: DataFrame, payload: str = "value") -> DataFrame:
    """Mail documents of visit records {id, fields{...}} in a JSON column: chunks joined by a space, recipients as lists, the rest as metadata."""
    v = F.try_parse_json(F.get_json_object(payload, "$.fields"))
    f = df.select(F.get_json_object(payload, "$.id").alias("id"), F.get_json_object(payload, "$.fields").alias("fj"), v.alias("f"))
    some = lambda c: F.when(c != "", c)
    chunks = F.try_variant_get("f", "$.chunks", "array<string>")
    content = F.coalesce(F.array_join(chunks, " "), _text(F.col("f"), "chunks"), F.lit(""))
    out = f.select(
        F.coalesce(some(F.col("id")), some(_text(F.col("f"), "docId")), some(_text(F.col("f"), "id"))).alias("id"),
        F.coalesce(some(_text(F.col("f"), "subject")), F.lit("No subject")).alias("title"),
        content.alias("content"), F.lit("email").alias("doc_type"),
        F.coalesce(some(_text(F.col("f"), "from")), F.lit("Unknown sender")).alias("source"),
        _list(F.col("f"), "to").alias("to"), _list(F.col("f"), "cc").alias("cc"), _list(F.col("f"), "bcc").alias("bcc"),
        timestamp(_text(F.col("f"), "timestamp")).alias("timestamp"), _list(F.col("f"), "permissions").alias("permissions"), _rest(F.col("fj")).alias("metadata"),
    )
    return out.where("id is not null")


def parse_hit(df: DataFrame, payload: str = "value", fallbacks: bool = True) -> DataFrame:
    """Search hits {id, fields{...}}: title, content and source fall back to subject, body and from; not for point lookups."""
    f = df.select(F.get_json_object(payload, "$.id").alias("hit"), F.get_json_object(payload, "$.fields").alias("fj")).withColumn("f", F.try_parse_json("fj"))
    t = lambda k: _text(F.col("f"), k)
    first = lambda *ks: F.coalesce(*[t(k) for k in (ks if fallbacks else ks[:1])])
    out = f.select(F.coalesce(t("id"), F.col("hit")).alias("id"), F.coalesce(first("title", "subject"), F.lit("Untitled")).alias("title"), F.coalesce(first("content", "body"), F.lit("")).alias("content"), F.coalesce(t("doc_type"), F.lit("document")).alias("doc_type"), timestamp(t("timestamp")).alias("timestamp"), first("source", "from").alias("source"), _rest(F.col("fj")).alias("metadata"))
    return out.where("id is not null")


def prepare(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text", prepared_text(F.col("title"), F.col("content")))


def read_json_documents(spark: SparkSession, path: str) -> DataFrame:
    """A file {"documents": [...]}; rows without id are skipped."""
    raw = spark.read.schema(f"documents array<struct<{', '.join(c.strip().replace(' ', ':', 1) for c in DOCUMENT.split(', '))}>>").json(path, multiLine=True)
    return raw.select(F.explode("documents").alias("d")).select("d.*").where("id is not null").withColumn("doc_type", F.coalesce("doc_type", F.lit("document")))


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON Lines; blank and broken lines are skipped."""
    return spark.read.schema(DOCUMENT).json(path, mode="DROPMALFORMED").where("id is not null").withColumn("doc_type", F.coalesce("doc_type", F.lit("document")))


def read_batches(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """Extraction batches, {results: [...]} or {entities, relations}, of a file or a folder: (file, item_id, entities, relations, error) per document.

    Entities and relations are arrays of JSON texts. A file that is neither gives one row with an error.
    """
    raw = spark.read.option("pathGlobFilter", pattern).text(path, wholetext=True)
    v = raw.select(F.input_file_name().alias("file"), F.try_parse_json("value").alias("v"))
    many = v.select("file", F.explode_outer(F.try_variant_get("v", "$.results", "array<variant>")).alias("r"), "v")
    r = F.coalesce("r", "v")
    array = lambda k: F.try_variant_get(r, f"$.{k}", "array<variant>")
    got = many.select("file", F.coalesce(F.try_variant_get(r, "$.item_id", "string"), F.try_variant_get(r, "$.source_item_id", "string"), F.lit("unknown")).alias("item_id"), array("entities").alias("e"), F.coalesce(array("relationships"), array("relations")).alias("q"))
    said = lambda c: F.transform(F.coalesce(c, F.array().cast("array<variant>")), lambda x: F.to_json(x))
    error = F.when(F.col("e").isNull() & F.col("q").isNull(), "unknown format")
    return got.select("file", "item_id", said(F.col("e")).alias("entities"), said(F.col("q")).alias("relations"), error.alias("error"))


def as_list(value: Column) -> Column:
    """A variant as a list of texts: an array's elements, a scalar alone, null for null."""
    one = F.try_variant_get(value, "$", "string")
    return F.coalesce(F.try_variant_get(value, "$", "array<string>"), F.when(one.isNotNull(), F.array(one)))


def batch_entities(batches: DataFrame) -> DataFrame:
    """Entity rows of read batches: item_id, batch_id, entity_name, entity_type, attributes, list_keys. The document's id joins the sources."""
    e = batches.select(F.col("item_id"), F.posexplode("entities").alias("batch_id", "json")).withColumn("v", F.try_parse_json("json"))
    at = lambda *ks: F.coalesce(*[F.try_variant_get("v", f"$.{k}", "string") for k in ks])
    e = e.select("item_id", "batch_id", at("entity_name", "name").alias("entity_name"), at("entity_type", "type").alias("entity_type"), F.coalesce(F.try_variant_get("v", "$.attributes", "map<string,variant>"), F.create_map().cast("map<string,variant>")).alias("m"))
    e = e.where("entity_name is not null and entity_type is not null").withColumns({"kept": F.map_filter(F.transform_values("m", lambda k, v: as_list(v)), lambda k, v: v.isNotNull() & (k != "sources")), "listed": F.map_keys(F.map_filter("m", lambda k, v: F.schema_of_variant(v).startswith("ARRAY")))})
    own = F.coalesce(as_list(F.try_element_at("m", F.lit("sources"))), F.array().cast("array<string>"))
    return e.select("item_id", "batch_id", "entity_name", "entity_type", F.map_concat("kept", F.create_map(F.lit("sources"), F.array_distinct(F.concat(own, F.array("item_id"))))).alias("attributes"), F.array_union("listed", F.array(F.lit("sources"))).alias("list_keys"))


def batch_relations(batches: DataFrame) -> DataFrame:
    """Relation rows of read batches: item_id, rel_no, endpoints, type, description, strength (1 without one), sources, permissions."""
    q = batches.select("item_id", F.posexplode("relations").alias("rel_no", "json")).withColumn("v", F.try_parse_json("json"))
    at = lambda *ks: F.coalesce(*[F.try_variant_get("v", f"$.{k}", "string") for k in ks])
    own = F.coalesce(as_list(F.try_variant_get("v", "$.sources", "variant")), F.array().cast("array<string>"))
    perms = F.coalesce(as_list(F.try_variant_get("v", "$.permissions", "variant")), F.array().cast("array<string>"))
    out = q.select("item_id", "rel_no", at("source_entity", "source").alias("source_entity"), at("target_entity", "target").alias("target_entity"), at("relationship_type", "type").alias("relationship_type"), at("description").alias("description"), F.coalesce(F.try_variant_get("v", "$.strength", "double"), F.lit(1.0)).alias("strength"), F.array_distinct(F.concat(own, F.array("item_id"))).alias("sources"), perms.alias("permissions"))
    return out.where("source_entity is not null and target_entity is not null")


def query(docs: DataFrame, text: str | None = None, doc_type: str | None = None, filters: dict | None = None, limit: int | None = None) -> DataFrame:
    """Conjunction of all words in title or content, a type and equality filters."""
    for word in (text or "").lower().split():
        if word != "true":
            docs = docs.where(F.lower(F.concat_ws(" ", "title", "content")).contains(word))
    if doc_type:
        docs = docs.where(F.col("doc_type") == doc_type)
    for k, v in (filters or {}).items():
        docs = docs.where(F.col(k) == v)
    return docs.limit(limit) if limit is not None else docs


def by_id(docs: DataFrame, doc_id: str) -> DataFrame:
    return docs.where(F.col("id") == doc_id)


def recent(docs: DataFrame, now: Column, hours: int = 24, doc_type: str | None = None) -> DataFrame:
    out = docs.where(F.col("timestamp") > now - F.make_dt_interval(F.lit(0), F.lit(hours)))
    return out.where(F.col("doc_type") == doc_type) if doc_type else out


def per_type(docs: DataFrame, types: list[str], limit: int, by: str = "doc_type", order: str = "id") -> DataFrame:
    """At most limit // len(types) documents of each type, in order. Ranks are cut inside tasks before the shuffle (window group limit)."""
    quota = max(1, limit // max(1, len(types)))
    w = Window.partitionBy(by).orderBy(order)
    return docs.where(F.col(by).isin(types)).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= quota).drop("_r")


def fetch_recent(docs: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """Recent documents, prepared for extraction."""
    return prepare(recent(docs, now, hours))


def search_content(docs: DataFrame, term: str, limit: int = 50) -> DataFrame:
    """Documents with all words of a term, prepared for extraction."""
    return prepare(query(docs, term, limit=limit))


def fetch_all(pages: DataFrame, max_documents: int | None = None, payload: str = "value") -> DataFrame:
    """All documents of a visit (JSON pages of any reader), parsed and prepared for extraction."""
    return prepare(parse_visit(visit_all(pages, max_documents), payload))


def to_json_text(docs: DataFrame) -> DataFrame:
    """A JSON object a document in column ``value``; null timestamps and fields are left out."""
    return docs.select(F.to_json(F.struct("*"), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss"}).alias("value"))


def from_json_text(rows: DataFrame, payload: str = "value") -> DataFrame:
    """Documents of JSON objects: unreadable timestamps are null, a missing type is document; rows without an id go."""
    d = rows.select(F.from_json(payload, DOCUMENT).alias("d")).select("d.*")
    return d.where("id is not null").withColumns({"doc_type": F.coalesce("doc_type", F.lit("document")), "timestamp": timestamp(F.col("timestamp"))})


def visit_all(pages: DataFrame, max_documents: int | None = None) -> DataFrame:
    return pages if max_documents is None else pages.limit(max_documents)


class VisitSource(DataSource):
    """``spark.read.format("visit")``: pages of a document server over HTTP, one partition per slice.

    Options: url, schema, namespace, cluster, page_size, slices, retries, timeout. The server gets
    ?wantedDocumentCount, cluster, selection, continuation, slices and sliceId.
    """

    @classmethod
    def name(cls) -> str:
        return "visit"

    def schema(self) -> str:
        return "value string"

    def reader(self, schema) -> DataSourceReader:
        return VisitReader(self.options)


class VisitReader(DataSourceReader):
    def __init__(self, options: dict):
        self.o = dict(options)

    def partitions(self):
        return [InputPartition(i) for i in range(int(self.o.get("slices", 1)))]

    def url(self, part: int, continuation: str | None) -> str:
        from urllib.parse import quote, urlencode

        params = {"wantedDocumentCount": self.o.get("page_size", "100"), "cluster": self.o.get("cluster", "content"), "selection": self.o.get("selection", self.o.get("schema", "mail")), "slices": self.o.get("slices", "1"), "sliceId": str(part)}
        if continuation:
            params["continuation"] = continuation
        return f"{self.o['url'].rstrip('/')}?{urlencode(params, quote_via=quote)}"

    def fetch(self, url: str) -> dict:
        import json
        import time
        from urllib.request import urlopen

        tries = int(self.o.get("retries", 3))
        for i in range(tries):
            try:
                with urlopen(url, timeout=float(self.o.get("timeout", 30))) as r:
                    return json.load(r)
            except OSError as e:
                code = getattr(e, "code", 500)  # an answer that a request is wrong stays the same
                if i + 1 == tries or 400 <= code < 500 and code not in (408, 429):
                    raise
                time.sleep(1)
        raise RuntimeError("no attempts")

    def works(self) -> bool:
        """Whether the server answers a request for one page."""
        try:
            return isinstance(self.fetch(self.url(0, None)), dict)
        except (OSError, ValueError):
            return False

    def read(self, partition):
        import json

        token = None
        while True:
            page = self.fetch(self.url(partition.value, token))
            for d in page.get("documents", []):
                yield (json.dumps(d),)
            token = page.get("continuation")
            if not token:
                return
