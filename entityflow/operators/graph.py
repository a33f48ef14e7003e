"""Queries over the two graph tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entityflow.functions.embed import Embedder, HashingEmbedder
from entityflow.functions.text import cosine, similarity_percent

TOP_LIMITS = (1, 50)


def type_counts(nodes: DataFrame, types: list[str], type_col: str = "type") -> DataFrame:
    """(type, n) of every declared type, with zeros."""
    dim = nodes.sparkSession.createDataFrame([(t,) for t in types], "type string")
    n = nodes.groupBy(F.col(type_col).alias("type")).agg(F.count("*").alias("n"))
    return dim.join(n, "type", "left").select("type", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def type_distribution(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "type")


def vector_top_k(rows: DataFrame, query: list[float], k: int, vector: str = "embedding", tie: str = "name") -> DataFrame:
    """The k rows of least cosine distance; each task keeps k rows, ties by name. Rows without a comparable vector are left out."""
    q = F.array(*[F.lit(float(x)) for x in query])
    d = (1 - cosine(F.col(vector), q)).alias("distance")
    return rows.select("*", d).where("distance is not null").orderBy("distance", tie).limit(k)


def neighbours(nodes: DataFrame, relations: DataFrame, kind: str, name: str, limit: int = 20) -> DataFrame:
    """Edges of a node in both directions with the node at the other end, in a fixed order."""
    def side(me: str, other: str, direction: str) -> DataFrame:
        e = relations.where((F.col(f"{me}_type") == kind) & (F.col(f"{me}_name") == name))
        return e.select(F.lit(direction).alias("direction"), F.col("type").alias("relation"), "strength", "description", F.col(f"{other}_type").alias("other_type"), F.col(f"{other}_name").alias("other_name"))

    e = side("src", "dst", "outgoing").unionByName(side("dst", "src", "incoming"))
    n = nodes.select(F.col("type").alias("other_type"), F.col("name").alias("other_name"))
    return e.join(n, ["other_type", "other_name"], "left_semi").orderBy("direction", "relation", "other_type", "other_name").limit(limit)


def between(relations: DataFrame, src: tuple[str, str], dst: tuple[str, str], tag: str | None = None) -> DataFrame:
    out = relations.where((F.col("src_type") == src[0]) & (F.col("src_name") == src[1]) & (F.col("dst_type") == dst[0]) & (F.col("dst_name") == dst[1]))
    return out.where(F.array_contains("relationTag", tag)) if tag is not None else out


def permitted(rows: DataFrame, principal: str | None, permissions: str = "permissions") -> DataFrame:
    return rows if principal is None else rows.where(F.array_contains(permissions, principal))


def hybrid_search(nodes: DataFrame, relations: DataFrame, query: list[float], principal: str, threshold: float, start_type: str = "Person") -> DataFrame:
    """Start nodes, edges and end nodes that the principal may see, scored by the mean of both ends' cosines, above a threshold."""
    q = F.array(*[F.lit(float(x)) for x in query])
    score = lambda c: cosine(F.col(c), q)
    n = permitted(nodes, principal).select("type", "name", "embedding")
    s = n.where(F.col("type") == start_type).select(F.col("type").alias("src_type"), F.col("name").alias("src_name"), score("embedding").alias("s"))
    d = n.select(F.col("type").alias("dst_type"), F.col("name").alias("dst_name"), score("embedding").alias("d"))
    out = permitted(relations, principal).join(s, ["src_type", "src_name"]).join(d, ["dst_type", "dst_name"])
    out = out.withColumn("score", (F.col("s") + F.col("d")) / 2).where(F.col("score") > threshold)
    return out.select("src_name", F.col("type").alias("relation"), "dst_type", "dst_name", "score").orderBy(F.desc("score"), "src_name", "dst_name")


def parse_command(line: str) -> tuple[str, tuple]:
    """A line of the interactive search: (command, arguments). For details and relations the last word is the type."""
    words = line.split()
    head = words[0].lower() if words else ""
    if head in ("details", "relations") and len(words) >= 3:
        return head, (" ".join(words[1:-1]), words[-1])
    if head in ("top", "simple") and len(words) >= 2:
        if head == "top":
            try:
                k = max(TOP_LIMITS[0], min(TOP_LIMITS[1], int(words[1])))
            except ValueError:
                return "search", (line.strip(), 10)
            return "search", (" ".join(words[2:]), k)
        return "simple", (" ".join(words[1:]),)
    if head in ("stats", "help", "exit", "quit") and len(words) == 1:
        return ("exit" if head == "quit" else head), ()
    return ("search", (line.strip(), 10)) if words else ("help", ())


class GraphSession:
    """Search, lookups and statistics over the tables of a graph; every read takes an optional principal."""

    def __init__(self, spark: SparkSession, nodes: DataFrame, relations: DataFrame, embedder: Embedder | None = None, principal: str | None = None):
        self.spark, self.embedder, self.principal = spark, embedder or HashingEmbedder(), principal
        self.nodes, self.relations = permitted(nodes, principal), permitted(relations, principal)

    def search(self, query: str, k: int = 10) -> DataFrame:
        text = f"Person. Name: SearchQuery. Description: {query}"
        vector = self.embedder.embed([text])[0].tolist()
        hits = vector_top_k(self.nodes, vector, max(TOP_LIMITS[0], min(TOP_LIMITS[1], k)))
        return hits.select("name", "type", F.slice("rawDescriptions", 1, 3).alias("rawDescriptions"), F.slice("aliases", 1, 3).alias("aliases"), "sources", "permissions", "distance", similarity_percent(F.col("distance")).alias("similarity"))

    def entity(self, kind: str, name: str) -> DataFrame:
        return self.nodes.where((F.col("type") == kind) & (F.col("name") == name))

    def details(self, name: str, kind: str) -> DataFrame:
        """(field, value) of what the node has, without its embedding."""
        row = self.entity(kind, name).drop("embedding")
        pairs = [F.struct(F.lit(f.name).alias("field"), (F.when(F.size(f.name) > 0, F.array_join(f.name, ", ")) if f.dataType.simpleString().startswith("array") else F.col(f.name).cast("string")).alias("value")) for f in row.schema.fields]
        return row.select(F.explode(F.array(*pairs)).alias("p")).select("p.*").where("value is not null and value <> ''")

    def relations_of(self, name: str, kind: str, limit: int = 20) -> DataFrame:
        return neighbours(self.nodes, self.relations, kind, name, limit)

    def relation(self, relation_id: str) -> DataFrame:
        return self.relations.where(F.col("relation_id") == relation_id)

    def persons(self) -> DataFrame:
        return self.nodes.where("type = 'Person'").orderBy("name")

    def stats(self) -> tuple[DataFrame, DataFrame]:
        return type_distribution(self.nodes), self.relations.agg(F.count("*").alias("relations"))

    def sql(self, query: str, **args) -> DataFrame:
        """Parameterised SQL over the views ``nodes`` and ``relations``."""
        self.nodes.createOrReplaceTempView("nodes")
        self.relations.createOrReplaceTempView("relations")
        return self.spark.sql(query, args=args)

    def run(self, line: str):
        command, args = parse_command(line)
        return {"search": self.search, "simple": lambda q: self.search(q).select("name", "type", "similarity"), "details": self.details, "relations": self.relations_of, "stats": self.stats}.get(command, lambda *a: None)(*args)


def edges_by_tags(relations: DataFrame) -> DataFrame:
    return relations.groupBy("relationTag").agg(F.count("*").alias("n"))


HELP = """free text              search for entities
details <name> <type>  fields of an entity
relations <name> <type>  its relations in both directions
top <n> <text>         search with n hits (1 to 50)
simple <text>          search without fields
stats                  numbers of entities and relations
help                   this text
exit                   end"""


def outgoing(relations: DataFrame, kind: str, name: str, tag: str | None = None) -> DataFrame:
    """Edges from a node, of one tag if asked for."""
    out = relations.where((F.col("src_type") == kind) & (F.col("src_name") == name))
    return out.where(F.array_contains("relationTag", tag)) if tag is not None else out


def two_hops(relations: DataFrame, start_type: str) -> DataFrame:
    """Directed paths of two edges from nodes of a type: (start, middle, end) names."""
    a = relations.where(F.col("src_type") == start_type).select(F.col("src_name").alias("start"), F.col("dst_name").alias("middle"), F.col("dst_type").alias("_t"))
    b = relations.select(F.col("src_name").alias("middle"), F.col("src_type").alias("_t"), F.col("dst_name").alias("end"))
    return a.join(b, ["middle", "_t"]).select("start", "middle", "end")


def with_email(nodes: DataFrame, email: str) -> DataFrame:
    return nodes.where(F.array_contains("emails", email))


def interactive(session: GraphSession, lines, show) -> int:
    """Answer lines until exit; ``show`` takes a text or a DataFrame. A line that fails is reported and the loop goes on. Returns the number of lines."""
    n = 0
    for line in lines:
        n += 1
        command, _ = parse_command(line)
        if command == "exit":
            break
        if command == "help":
            show(HELP)
            continue
        try:
            out = session.run(line)
        except Exception as e:  # noqa: BLE001  one bad line must not end the loop
            show(f"{type(e).__name__}: {e}")
            continue
        for df in out if isinstance(out, tuple) else (out,):
            show(df)
    return n
