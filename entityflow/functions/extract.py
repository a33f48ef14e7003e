"""Extraction step: a protocol for model plug-ins and a deterministic rule-based default that emits the tuple format."""

from __future__ import annotations

from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entityflow.config import Config
from entityflow.functions.text import strip

EMAIL = r"([A-Za-z0-9._%+-]+)@([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)"


class Extractor(Protocol):
    def extract(self, texts: list[str]) -> list[str]: ...


#: What a prompt says about the texts of a data type.
ABOUT = {
    "email": "The text is an e-mail. Look for the people and organisations that write, are written to or are spoken of, and for what they plan and decide.",
    "document": "The text is a document. Look for organisations, projects, teams and people, for who wrote, reviewed, describes or refers to what, and for states, dates and owners of projects.",
    "code": "The text is about code. Look for repositories, branches, changes and issues, and for who made, reviewed or reported them.",
    "meeting": "The text is the record of a meeting. Look for who took part, for topics, decisions and tasks with their owners.",
    "chat": "The text is a chat. Look for who talks to whom, for topics, and for projects, issues and events that they mention.",
}


def prompt(config: Config | None = None, data_type: str = "email", entity_types: list[str] | None = None) -> str:
    """System prompt for a model: what to look for, the types with their attributes, and the record format."""
    c = config or Config()
    types = "\n".join(f"- {t}: {', '.join(fs)}" for t, fs in c.prompt_fields.items() if entity_types is None or t in entity_types)
    return f'{ABOUT.get(data_type, ABOUT["email"])}\nList entities and relationships of the text, one record a line, each ending in ##.\nEntities: ("entity"<|>name<|>type<|>"key": "value"...)\nRelationships: ("relationship"<|>source<|>target<|>type<|>description<|>strength 1-10)\nEnd with <|COMPLETE|>. Types and attributes:\n{types}'


def extraction_prompt(context: str, config: Config | None = None, data_type: str = "email", entity_types: list[str] | None = None) -> str:
    """The message with one text."""
    names = entity_types or list((config or Config()).prompt_fields)
    return f"Entity types: {', '.join(names)}\n{data_type.capitalize()} text: {context}\n\nReturn only records in the format above and end with <|COMPLETE|>."


class ChatExtractor:
    """An extractor over any chat model: ``call(system, user) -> text``; a failed call gives an empty text."""

    def __init__(self, call, config: Config | None = None, data_type: str = "email"):
        self.call, self.config, self.data_type = call, config, data_type

    def extract(self, texts: list[str]) -> list[str]:
        out = []
        for t in texts:
            try:
                out.append(self.call(prompt(self.config, self.data_type), extraction_prompt(t, self.config, self.data_type)) or "")
            except Exception:  # noqa: BLE001  the model's failure is an empty answer
                out.append("")
        return out


def extract_with(docs: DataFrame, extractor: Extractor, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """item_id, raw_output, error by a plug-in, in Arrow batches; empty texts are errors, a failing batch fails its rows only."""
    def run(batches):
        for b in batches:
            texts = b["text"].fillna("").tolist()
            ok = [i for i, t in enumerate(texts) if t.strip()]
            out, err = [None] * len(texts), ["empty content"] * len(texts)
            try:
                for i, o in zip(ok, extractor.extract([texts[i] for i in ok])):
                    out[i], err[i] = o, None
            except Exception as e:  # noqa: BLE001  the plug-in's own failure becomes a row's status
                for i in ok:
                    err[i] = f"{type(e).__name__}: {e}"
            yield pd.DataFrame({"item_id": b["item_id"], "raw_output": out, "error": err})

    return docs.select(F.col(item_id).cast("string").alias("item_id"), F.col(text).alias("text")).mapInPandas(run, "item_id string, raw_output string, error string")


def extract_rules(docs: DataFrame, text: str = "text", source: str = "source", item_id: str = "item_id") -> DataFrame:
    """The default, in column expressions: a topic per source; a person and an organisation per e-mail address, and the edges between them."""
    def topic(s):
        return F.concat(F.lit('("entity"<|>'), s, F.lit('<|>Topic<|>"keywords": "['), s, F.lit(']")##'))

    mails = F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(EMAIL), F.lit(0)))
    user, host = (lambda m: F.split_part(m, F.lit("@"), F.lit(1))), (lambda m: F.split_part(m, F.lit("@"), F.lit(2)))
    lines = F.transform(mails, lambda m: F.concat(
        F.lit('("entity"<|>'), user(m), F.lit('<|>Person<|>"email": "'), m, F.lit('"<|>"emails": "['), m, F.lit(']"<|>"worksAt": "'), host(m), F.lit('")##\n("entity"<|>'), host(m), F.lit('<|>Organization<|>"domain": "'), host(m),
        F.lit('")##\n("relationship"<|>'), user(m), F.lit("<|>"), host(m), F.lit("<|>WORKS_AT<|>address of the organisation<|>8)##\n(\"relationship\"<|>"), user(m), F.lit("<|>"), F.col(source), F.lit("<|>MENTIONED_IN<|>found in the source<|>5)##")))
    out = F.concat_ws("\n", topic(F.col(source)), F.array_join(lines, "\n"), F.lit("<|COMPLETE|>"))
    empty = strip(F.coalesce(F.col(text), F.lit(""))) == ""
    return docs.select(F.col(item_id).cast("string").alias("item_id"), F.when(~empty, out).alias("raw_output"), F.when(empty, F.lit("empty content")).alias("error"))
