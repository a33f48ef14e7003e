"""Table schemas and catalogue operations of the property graph."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .config import DATE_FIELDS, Config

# The type words of schema files.
_TYPES = {"STRING": T.StringType(), "STRING PRIMARY KEY": T.StringType(), "STRING[]": T.ArrayType(T.StringType()), "DOUBLE[]": T.ArrayType(T.FloatType()), "FLOAT": T.FloatType(), "DATE": T.DateType(), "TIMESTAMP": T.TimestampType()}


def spark_type(name: str) -> T.DataType | None:
    """Type of a schema file's word; None for endpoint markers; FLOAT[n] is an array."""
    name = name.strip()
    if name == "ANY":
        return None
    if name.startswith("FLOAT["):
        return T.ArrayType(T.FloatType())
    return _TYPES[name]


def separate(schema: dict) -> tuple[dict, dict]:
    """(entity types, relation) of a schema mapping; without a relation the default one."""
    entities = {k: v for k, v in schema.items() if k != "Relation"}
    # The relation of a schema file without one.
    default = {"relation_id": "STRING PRIMARY KEY", "description": "STRING[]", "relationTag": "STRING[]", "type": "STRING", "strength": "FLOAT", "permissions": "STRING[]", "sources": "STRING[]", "createdAt": "STRING", "lastUpdated": "STRING", "embedding": "FLOAT[1024]"}
    return entities, schema.get("Relation", default)


def unify(entities: dict) -> T.StructType:
    """One sparse node schema: type and name, then every field, first definition first."""
    out = {"type": T.StringType(), "name": T.StringType()}
    for fields in entities.values():
        for f, kind in fields.items():
            if (t := spark_type(kind)) is not None:
                out.setdefault(f, t)
    return T.StructType([T.StructField(k, v) for k, v in out.items()])


def load(path: str) -> tuple[T.StructType, T.StructType]:
    import yaml

    entities, relation = separate(yaml.safe_load(open(path, encoding="utf-8")))
    fields = [T.StructField(k, spark_type(v)) for k, v in relation.items() if spark_type(v) is not None]
    return unify(entities), T.StructType([*_ENDPOINTS, *fields])


_ENDPOINTS = [T.StructField(c, T.StringType()) for c in ("src_type", "src_name", "dst_type", "dst_name")]


def nodes_schema(config: Config | None = None) -> T.StructType:
    c = config or Config()
    scalars = [T.StructField(f, T.DateType() if f in DATE_FIELDS else T.StringType()) for f in c.all_scalars() if f != "name"]
    arrays = [T.StructField(f, T.ArrayType(T.StringType())) for f in c.all_arrays()]
    return T.StructType([T.StructField("type", T.StringType()), T.StructField("name", T.StringType()), *scalars, *arrays, T.StructField("embedding", T.ArrayType(T.FloatType()))])


def relations_schema() -> T.StructType:
    arr = T.ArrayType(T.StringType())
    rest = [("description", arr), ("relationTag", arr), ("type", T.StringType()), ("strength", T.DoubleType()), ("permissions", arr), ("sources", arr), ("createdAt", T.StringType()), ("lastUpdated", T.StringType()), ("embedding", T.ArrayType(T.FloatType()))]
    return T.StructType([T.StructField("relation_id", T.StringType()), *_ENDPOINTS, *[T.StructField(n, t) for n, t in rest]])


def _number(snapshot: str) -> int:
    return int(snapshot[2:].partition("-")[0])


class GraphStore:
    """Versioned Parquet snapshots of ``nodes`` and ``relations`` below a base path.

    A commit writes new snapshots and then one log entry that names the snapshot of every table, by an atomic rename; so
    readers see both tables of one commit or of another, never a mix or half a table. Snapshots of the
    commit before stay for readers that still use them; older ones are deleted.
    """

    TABLES = ("nodes", "relations")

    def __init__(self, spark: SparkSession, base: str, config: Config | None = None):
        self.spark, self.base, self.config = spark, base.rstrip("/"), config or Config()

    def _fs(self, path: str):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def schema(self, table: str) -> T.StructType:
        return nodes_schema(self.config) if table == "nodes" else relations_schema()

    def _names(self, path: str) -> list[str]:
        fs, at = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []

    def log(self) -> dict[int, dict[str, str]]:
        """Commits that are still kept: number -> snapshot folder of each table."""
        out = {}
        for name in self._names(f"{self.base}/_log"):
            if name.isdigit():
                fs, at = self._fs(f"{self.base}/_log/{name}")
                with_stream = fs.open(at)
                out[int(name)] = json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(with_stream, "UTF-8"))
                with_stream.close()
        return out

    def _snapshot(self, table: str) -> str | None:
        log = self.log()
        return log[max(log)].get(table) if log else None

    def version(self, table: str) -> int | None:
        """Number of the commit that wrote the table's snapshot."""
        name = self._snapshot(table)
        return None if name is None else _number(name)

    def exists(self, table: str) -> bool:
        return self.version(table) is not None

    def works(self) -> bool:
        """Whether the base path can be reached and its log read."""
        try:
            self.log()
            return True
        except Exception:  # noqa: BLE001  any failure of the file system is the answer
            return False

    def read(self, table: str) -> DataFrame:
        name = self._snapshot(table)
        if name is None:
            return self.spark.createDataFrame([], self.schema(table))
        return self.spark.read.schema(self.schema(table)).parquet(f"{self.base}/{table}/{name}")

    def commit(self, **tables: DataFrame) -> int:
        """New snapshots of the given tables, all visible at once; the others keep theirs. A commit of another writer in between raises."""
        log = self.log()
        n = max(log, default=-1) + 1
        name = f"v={n}-{uuid.uuid4().hex}"  # no other writer's
        for table, df in tables.items():
            kinds = self.schema(table)
            df.select(*[F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in kinds.fields]).write.parquet(f"{self.base}/{table}/{name}")
        entry = {**(log[max(log)] if log else {}), **dict.fromkeys(tables, name)}
        fs, draft = self._fs(f"{self.base}/_log/_draft-{uuid.uuid4().hex}")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        if not fs.rename(draft, self._fs(f"{self.base}/_log/{n:010d}")[1]):
            fs.delete(draft, False)
            for table in tables:
                fs.delete(self._fs(f"{self.base}/{table}/{name}")[1], True)
            raise RuntimeError(f"commit {n} exists: another writer was faster")
        self._forget({**log, n: entry}, n)
        return n

    def _forget(self, log: dict[int, dict[str, str]], n: int) -> None:
        """Delete what neither this commit nor the one before it reads."""
        kept = [e for k, e in log.items() if k >= n - 1]
        fs, _ = self._fs(self.base)
        for k in log:
            if k < n - 1:
                fs.delete(self._fs(f"{self.base}/_log/{k:010d}")[1], False)
        for t in self.TABLES:
            used = {e[t] for e in kept if t in e}
            for name in self._names(f"{self.base}/{t}"):
                if name.startswith("v=") and name not in used and _number(name) < n:
                    fs.delete(self._fs(f"{self.base}/{t}/{name}")[1], True)

    def keep_status(self, rows: DataFrame) -> DataFrame:
        """A run's result as a table of its own, so that it outlives the run's scratch tables."""
        path = f"{self.base}/_runs/{uuid.uuid4().hex}"
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def create(self) -> None:
        if missing := [t for t in self.TABLES if not self.exists(t)]:
            self.commit(**{t: self.spark.createDataFrame([], self.schema(t)) for t in missing})

    def drop(self) -> None:
        """Delete tables, log and run results; missing ones do not matter."""
        for t in ("_log", *reversed(self.TABLES), "_runs", "_work"):
            fs, at = self._fs(f"{self.base}/{t}")
            fs.delete(at, True)

    def migrate(self, clean_first: bool = True) -> None:
        if clean_first:
            self.drop()
        self.create()

    def clean(self) -> None:
        """Delete all rows of both tables at once."""
        self.commit(**{t: self.spark.createDataFrame([], self.schema(t)) for t in self.TABLES})

    def list_tables(self) -> list[str]:
        return [t for t in self.TABLES if self.exists(t)]

    def info(self) -> DataFrame:
        from .operators.graph import type_counts

        n = type_counts(self.read("nodes"), self.config.entity_types())
        return n.unionByName(self.read("relations").agg(F.lit("Relation").alias("type"), F.count("*").alias("n")))

    def backup_schema(self, path: str) -> None:
        """The schemas as one JSON file in any file system that Spark reaches."""
        fs, at = self._fs(path)
        out = fs.create(at, True)
        out.write(bytearray(json.dumps({t: json.loads(self.schema(t).json()) for t in self.TABLES}, indent=1).encode()))
        out.close()
