"""Command line: schema tool, merge of batch files, pipeline run with progress, search."""

from __future__ import annotations

import argparse
import sys
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import Settings
from .schema import GraphStore


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="entityflow", description=__doc__)
    p.add_argument("--base", help="folder of the graph tables")
    sub = p.add_subparsers(dest="command")
    plain = (("init", "create missing tables"), ("clean", "drop and create all tables"), ("migrate", "drop and create all tables"), ("clear", "delete all rows"), ("status", "row counts"), ("schema", "print the schemas"), ("test", "whether the store can be reached"), ("persons", "all persons by name"), ("progress", "summary of all sessions"), ("reset", "failed documents become new ones"), ("interactive", "search until exit, a command a line"))
    for name, text in plain:
        sub.add_parser(name, help=text)
    sub.add_parser("backup", help="write the schemas as JSON").add_argument("path")
    search = sub.add_parser("search", help="one command of the interactive search")
    search.add_argument("words", nargs="+")
    merge = sub.add_parser("merge", help="merge extraction batches of a file or folder")
    merge.add_argument("path")
    merge.add_argument("--pattern", default="*.json")
    run = sub.add_parser("run", help="ingest documents that are not processed yet (.json, .jsonl or Parquet)")
    run.add_argument("path")
    run.add_argument("--max", type=int, default=None, help="documents of this run at most")
    return p


def documents_of(spark: SparkSession, path: str) -> DataFrame:
    """Documents with id, text, source and permissions, as far as the file has them."""
    from .sources import documents as sources

    if path.endswith((".json", ".jsonl")):
        read = sources.read_json_documents if path.endswith(".json") else sources.read_json_lines
        return sources.prepare(read(spark, path)).select("id", "text", "source")
    return spark.read.parquet(path)


def _show(x) -> None:
    if isinstance(x, DataFrame):
        x.show(50, truncate=False)
    else:
        print(x)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = parser()
    a = p.parse_args(argv)
    if not a.command:
        p.print_help()
        return 1
    settings = Settings.from_env()
    base = a.base or settings.base
    spark = spark or SparkSession.builder.appName("entityflow").getOrCreate()
    store = GraphStore(spark, base)
    from .operators.graph import GraphSession, interactive
    from .plans.pipeline import merge_files
    from .streaming.ingest import Progress, run

    progress = Progress(spark, f"{base}/_progress")
    session = lambda: GraphSession(spark, store.read("nodes"), store.read("relations"))
    now = F.lit(spark.range(1).select(F.current_timestamp().cast("string")).first()[0])
    if a.command == "init":
        store.create()
    elif a.command in ("clean", "migrate"):
        store.migrate()
    elif a.command == "clear":
        store.clean()
    elif a.command == "status":
        store.info().orderBy("type").show(100, truncate=False)
    elif a.command == "schema":
        for t in store.TABLES:
            print(t, store.schema(t).simpleString())
    elif a.command == "backup":
        store.backup_schema(a.path)
    elif a.command == "test":
        print("reached" if (ok := store.works()) else "not reached")
        return 0 if ok else 1
    elif a.command == "persons":
        _show(session().persons().select("name", "emails", "role", "worksAt"))
    elif a.command == "merge":
        began = time.monotonic()
        stats = merge_files(spark, a.path, store, now, a.pattern)
        print(f"{time.monotonic() - began:.1f} seconds")
        _show(stats.orderBy("file"))
        _show(store.info().orderBy("type"))
        return 1 if stats.agg(F.sum("errors")).first()[0] else 0
    elif a.command == "run":
        most = a.max if a.max is not None else settings.max_documents
        _show(run(spark, documents_of(spark, a.path), store, progress, uuid.uuid4().hex, now, most, f"{base}/_output" if settings.save_results else None))
    elif a.command == "progress":
        _show(progress.summary())
        _show(progress.sessions())
    elif a.command == "reset":
        n = progress.latest().where("status = 'failed'").count()
        progress.reset_failed(spark.range(1).select(now).first()[0])
        print(f"{n} failed documents are new again")
    elif a.command == "search":
        out = session().run(" ".join(a.words))
        for df in out if isinstance(out, tuple) else (out,) if out is not None else ():
            _show(df)
    elif a.command == "interactive":
        interactive(session(), sys.stdin, _show)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
