"""Scalar functions as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def normalise(c: Column) -> Column:
    """Lower case, stripped; null becomes empty."""
    return F.coalesce(F.lower(strip(c)), F.lit(""))


def prepared_text(title: Column, content: Column) -> Column:
    return F.concat(F.coalesce(title, F.lit("")), F.lit("\n\n"), F.coalesce(content, F.lit("")))


def timestamp(c: Column) -> Column:
    """Numbers above 1e10 are milliseconds, other numbers seconds; other text is ISO; the rest is null. UTC."""
    x = c.try_cast("double")
    number = F.when(x > 1e10, F.timestamp_millis(x.cast("long"))).otherwise(F.timestamp_micros((x * 1000000).cast("long")))
    return F.when(x.isNotNull(), number).otherwise(F.try_to_timestamp(c.cast("string")))


def relation_id(src: Column, kind: Column, dst: Column) -> Column:
    return F.sha2(F.concat_ws("::", src, kind, dst), 256)


def tagged_relation_id(src: Column, kind: Column, tag: Column, dst: Column) -> Column:
    return F.sha2(F.concat_ws("::", src, kind, tag, dst), 256)


def json_text(attributes: Column, list_keys: Column) -> Column:
    """A map of value lists as one JSON object with sorted keys; values of keys that are no lists are scalars."""
    quoted = lambda v: F.substring(F.to_json(F.array(v)), F.lit(2), F.length(F.to_json(F.array(v))) - 2)
    many = lambda vs: F.concat(F.lit("["), F.array_join(F.transform(vs, quoted), ", "), F.lit("]"))
    pair = lambda k: F.concat(quoted(k), F.lit(": "), F.when(F.array_contains(list_keys, k) | (F.size(attributes[k]) != 1), many(attributes[k])).otherwise(quoted(F.get(attributes[k], F.lit(0)))))
    return F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(F.map_keys(attributes)), pair), ", "), F.lit("}"))


def entity_id(kind: Column, name: Column, first_email: Column, works_at: Column, domain: Column, fallback: Column | None = None) -> Column:
    """Hash of the type and the best key: a person's first e-mail, or name with employer, or name; an organisation's domain or name; else the name.

    Without any of them the key is ``fallback`` (the attributes as ``json_text``), so nameless entities of one type stay apart.
    """
    some = lambda c: F.when(c != "", F.lower(c))
    said = lambda label, *cs: F.concat(F.lit(f"::{label}::"), F.array_join(F.array(*cs), "::"))
    mail, place, at, own = some(first_email), some(works_at), some(domain), some(name)
    by_name = F.when(own.isNotNull(), said("name", own))
    person = F.when(mail.isNotNull(), said("email", mail)).when(own.isNotNull() & place.isNotNull(), said("name_worksAt", own, place)).otherwise(by_name)
    key = F.when(kind == "Person", person).when((kind == "Organization") & at.isNotNull(), said("domain", at)).otherwise(by_name)
    return F.sha2(F.concat(kind, F.coalesce(key, F.concat(F.lit("::fallback::"), F.coalesce(fallback if fallback is not None else F.lit(None).cast("string"), F.lit("{}"))))), 256)


def fallback_name(name: Column, title: Column, email: Column) -> Column:
    some = lambda c: F.when(c != "", c)
    return F.coalesce(some(name), some(title), F.when(email != "", F.concat(F.lit("User_"), F.split_part(email, F.lit("@"), F.lit(1)))), F.sha2(F.concat_ws("|", name, title, email), 256))


def entity_text(kind: Column, name: Column, descriptions: Column, **extra: Column) -> Column:
    """Text that stands for a node in embeddings: type, name, first three descriptions and further fields, joined by ". "."""
    said = F.array_join(F.slice(F.filter(F.coalesce(descriptions, F.array().cast("array<string>")), lambda d: d != ""), 1, 3), " ")
    parts = [kind, F.when(name != "", F.concat(F.lit("Name: "), name)), F.when(said != "", F.concat(F.lit("Description: "), said))]
    parts += [F.when(c != "", F.concat(F.lit(f"{k.capitalize()}: "), c)) for k, c in extra.items()]
    return F.concat_ws(". ", *parts)


def relation_text(tags: Column, kind: Column, descriptions: Column, strength: Column) -> Column:
    parts = [F.when(F.size(tags) > 0, F.concat(F.lit("Relation: "), F.array_join(tags, ", "))).otherwise(F.when(kind != "", F.concat(F.lit("Relation: "), kind))), F.when(F.size(descriptions) > 0, F.concat(F.lit("Description: "), F.array_join(descriptions, ", "))), F.when(strength.isNotNull(), F.concat(F.lit("Strength: "), strength.cast("string")))]
    text = F.concat_ws(". ", *parts)
    return F.when(text == "", F.lit("Generic relation")).otherwise(text)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two float arrays, in double; null for unequal lengths or zero vectors."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0).cast("double"), lambda s, v: s + v)
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when((F.size(a) == F.size(b)) & (norms > 0), dot(a, b) / norms)


def similarity_percent(distance: Column) -> Column:
    return F.coalesce(F.greatest(F.lit(0.0), (1 - distance.try_cast("double")) * 100), F.lit(0.0))


def success_rate(done: Column, failed: Column) -> Column:
    return F.coalesce(F.try_divide(done * 100.0, done + failed), F.lit(0.0))


def append_unique(old: Column, new: Column) -> Column:
    """Old values as they are, then the new ones that are not among them, once each."""
    empty = F.array().cast("array<string>")
    old, new = F.coalesce(old, empty), F.coalesce(new, empty)
    return F.concat(old, F.array_except(new, old))


def lists_overlap(a: Column, b: Column) -> Column:
    clean = lambda c: F.filter(F.transform(c, normalise), lambda x: x != "")
    return F.arrays_overlap(clean(a), clean(b))


# The data types and the keys that tell them, first type first.
DATA_TYPES = ("email", "document", "code", "meeting", "chat")
TYPE_KEYS = {
    "email": ("from", "to", "subject", "sender", "recipient"),
    "code": ("repository", "commit", "pull_request", "code", "file_path"),
    "meeting": ("meeting_title", "attendees", "transcript", "agenda"),
    "chat": ("channel", "thread", "message_thread", "chat_id"),
}


def data_type(explicit: Column, has: dict[str, Column]) -> Column:
    """An explicit known type, else by the keys a record has, else email. has: key -> whether it is there."""
    out = F.when(F.lower(explicit).isin(*DATA_TYPES), F.lower(explicit))
    for kind, keys in TYPE_KEYS.items():
        if there := [has[k] for k in keys if k in has]:
            out = out.when(reduce(lambda x, y: x | y, there), kind)
    return out.otherwise("email")


def data_type_of(record: Column) -> Column:
    """The data type of a JSON object's text by its own keys."""
    keys = F.coalesce(F.json_object_keys(record), F.array().cast("array<string>"))
    return data_type(F.get_json_object(record, "$.data_type"), {k: F.array_contains(keys, k) for ks in TYPE_KEYS.values() for k in ks})


def sequence_ratio(a: Column, b: Column) -> Column:
    """Ratcliff-Obershelp similarity of two strings; vectorised Python, as no built-in has this metric."""
    from difflib import SequenceMatcher

    import pandas as pd

    def ratio(x, y):
        return pd.Series([SequenceMatcher(None, p or "", q or "").ratio() for p, q in zip(x, y)])

    ratio.__annotations__ = {"x": pd.Series, "y": pd.Series, "return": pd.Series}  # the module's own are strings
    return F.pandas_udf(ratio, "double")(a, b)
