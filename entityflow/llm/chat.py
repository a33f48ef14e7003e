r"""Chat formatting by schema fingerprints, in DataFrame functions only.

Records arrive as JSON or as one struct column. A row's fingerprint is the hash of the
nested field paths that the row itself has, unknown ones included (top-level nulls
are absent; elements of an array add their fields up); it selects a declarative
mapping (``LAYOUTS``) that turns the row into canonical turns ``array<struct<role,
text>>``. ``render`` then writes the template as a list of segments, each with its loss
flag, and ``parse`` reads turns back from the formatted string.

Template: ``<|role|>\n`` text ``<|end|>\n`` per turn. Inside roles and texts
``\``, ``<`` and ``[`` become ``\s``, ``\l`` and ``\b``, and inside roles ``|`` becomes
``\p``, so no control string (``<|end|>``, ``</s>``, ``[INST]`` ...) survives in a body, no
role ends early and the change is reversible.

Edge cases: a null role or text is an empty string; a record whose
fingerprint matches no layout (an unknown key, a missing field, an empty array) gets null
turns (and so null output) and keeps its fingerprint for inspection; an empty turn list formats as "". Turns with
equal numbers are ordered by role, then text; a null conv_id is one
conversation of its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import col, read

TURNS = "array<struct<role:string,text:string>>"
_PAIR = "array<struct<role:string,content:string>>"
_SHARE = "array<struct<from:string,value:string>>"
#: Union of the layouts that records may have.
RECORD = f"struct<messages:{_PAIR},conversations:{_SHARE},system:string,prompt:string,response:string,completion:string,instruction:string,input:string,output:string,question:string,answer:string>"

#: name -> (paths that are present, mapping). A mapping is either
#: ("list", array, role field, text field, role renames) or ("fixed", [(role, [fields joined by a blank line])]).
LAYOUTS: dict[str, tuple[tuple[str, ...], tuple]] = {
    "messages": (("messages[].role", "messages[].content"), ("list", "messages", "role", "content", {})),
    "sharegpt": (("conversations[].from", "conversations[].value"), ("list", "conversations", "from", "value", {"human": "user", "gpt": "assistant"})),
    "sharegpt_system": (("conversations[].from", "conversations[].value", "system"), ("list", "conversations", "from", "value", {"human": "user", "gpt": "assistant"})),
    "prompt_response": (("prompt", "response"), ("fixed", [("user", ["prompt"]), ("assistant", ["response"])])),
    "prompt_completion": (("prompt", "completion"), ("fixed", [("user", ["prompt"]), ("assistant", ["completion"])])),
    "system_prompt_response": (("system", "prompt", "response"), ("fixed", [("system", ["system"]), ("user", ["prompt"]), ("assistant", ["response"])])),
    "instruction": (("instruction", "output"), ("fixed", [("user", ["instruction"]), ("assistant", ["output"])])),
    "instruction_input": (("instruction", "input", "output"), ("fixed", [("user", ["instruction", "input"]), ("assistant", ["output"])])),
    "question_answer": (("question", "answer"), ("fixed", [("user", ["question"]), ("assistant", ["answer"])])),
    "prompt": (("prompt",), ("fixed", [("user", ["prompt"])])),
}

_ESCAPES = (("\\", "\\s"), ("<", "\\l"), ("[", "\\b"))
END = "<|end|>\n"


_ROLE_ESCAPES = (*_ESCAPES, ("|", "\\p"))


def escape(c: Column, pairs: tuple = _ESCAPES) -> Column:
    return reduce(lambda x, e: F.replace(x, F.lit(e[0]), F.lit(e[1])), pairs, c)


def unescape(c: Column, pairs: tuple = _ESCAPES) -> Column:
    return reduce(lambda x, e: F.replace(x, F.lit(e[1]), F.lit(e[0])), reversed(pairs), c)


def field_paths(value: Column) -> Column:
    """The nested field paths of a variant as one text, such as ``messages[role,content]`` in the order of names; null for null."""
    text = F.regexp_replace(F.schema_of_variant(value), r"ARRAY<OBJECT<", "[")
    # a null inside an array's objects is a field without text; at the top it is no field
    for _ in range(4):
        text = F.regexp_replace(text, r"(\[[^\[\]<>]*): VOID", "$1")
    text = F.regexp_replace(text, r"(?:^OBJECT<|, )[^\s:,<>\[\]]+: VOID(?=, |>$)", ",")
    text = F.regexp_replace(text, r": (?:STRING|BIGINT|DOUBLE|FLOAT|BOOLEAN|DATE|TIMESTAMP|TIMESTAMP_NTZ|DECIMAL\([0-9, ]*\))(?=[,>])", "")
    text = F.regexp_replace(F.regexp_replace(text, ">>", "]"), r"^OBJECT<|>$|: (?=\[)", "")
    return F.regexp_replace(F.regexp_replace(text, r"(?:,\s*)+", ","), "^,|,$", "")


def fingerprint(paths: Column) -> Column:
    return F.xxhash64(paths)


def _key(paths: tuple[str, ...]) -> str:
    """A layout's paths in the form of ``field_paths``."""
    arrays = {p.split("[].")[0] for p in paths if "[]." in p}
    inner = {a: ",".join(sorted(p.split("[].")[1] for p in paths if p.startswith(a + "[]."))) for a in arrays}
    return ",".join(sorted([*(p for p in paths if "[]." not in p), *(f"{a}[{x}]" for a, x in inner.items())]))


def _mapped(record: Column, mapping: tuple) -> Column:
    text = lambda c: F.coalesce(c, F.lit(""))
    if mapping[0] == "list":
        _, array, role, body, renames = mapping

        def turn(m: Column) -> Column:
            r = reduce(lambda x, kv: F.when(m[role] == kv[0], F.lit(kv[1])).otherwise(x), renames.items(), text(m[role]))
            return F.struct(r.alias("role"), text(m[body]).alias("text"))

        return F.transform(record[array], turn)
    turns = [F.struct(F.lit(role).alias("role"), F.concat_ws("\n\n", *[F.when(F.length(record[f]) > 0, record[f]) for f in fields]).alias("text")) for role, fields in mapping[1]]
    return F.array(*turns)


def canonical_turns(df: DataFrame, record: str, paths: str | None = None) -> DataFrame:
    """Add ``fingerprint``, ``layout`` and ``turns`` for the struct column ``record`` (any subset of RECORD's fields; others are unknown paths).
    ``paths`` names a column with the rows' paths, where they come from JSON; else they are read from the struct."""
    r = col(record)
    own = col(paths) if paths else field_paths(F.parse_json(F.to_json(r, {"ignoreNullFields": "false"})))
    known = {f.name for f in df.schema[record].dataType.fields}
    out = df.withColumn("_paths", own).withColumn("fingerprint", fingerprint(F.col("_paths")))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for name, (wanted, mapping) in LAYOUTS.items():
        if {p.split("[].")[0] for p in wanted} <= known:
            hit = (F.col("fingerprint") == F.xxhash64(F.lit(_key(wanted)))) & r.isNotNull()
            layout = F.when(hit, F.lit(name)).otherwise(layout)
            got = _mapped(r, mapping)
            if name == "sharegpt_system":
                got = F.concat(F.array(F.struct(F.lit("system").alias("role"), F.coalesce(r["system"], F.lit("")).alias("text"))), got)
            turns = F.when(hit, got.cast(TURNS)).otherwise(turns)
    return out.withColumns({"layout": layout, "turns": turns}).drop("_paths")


def from_json(df: DataFrame, payload: str, to: str = "record", paths: str = "paths") -> DataFrame:
    """JSON lines of any layout into the union record, and the paths that each has; text that is not a JSON object gives a null record and null paths."""
    v = F.try_parse_json(col(payload))
    plain = F.schema_of_variant(v).startswith("OBJECT<")
    return df.withColumns({to: F.when(plain, F.from_json(col(payload), RECORD)), paths: F.when(plain, field_paths(v))})


def render(df: DataFrame, turns: str = "turns", loss_role: str = "assistant") -> DataFrame:
    """Add ``formatted`` and ``segments`` (text pieces in order with their loss flag; their concatenation is ``formatted``)."""
    def pieces(t: Column) -> Column:
        role, body = F.coalesce(t["role"], F.lit("")), F.coalesce(t["text"], F.lit(""))
        seg = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(seg(F.concat(F.lit("<|"), escape(role, _ROLE_ESCAPES), F.lit("|>\n")), F.lit(False)), seg(escape(body), role == loss_role), seg(F.lit(END), F.lit(False)))

    out = df.withColumn("segments", F.flatten(F.transform(col(turns), pieces)))
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def parse(formatted: Column) -> Column:
    """Canonical turns read back from the formatted string."""
    body = F.filter(F.split(formatted, r"<\|end\|>\n"), lambda p: p != "")
    return F.transform(body, lambda p: F.struct(unescape(F.regexp_extract(p, r"(?s)^<\|(.*?)\|>\n", 1), _ROLE_ESCAPES).alias("role"), unescape(F.regexp_replace(p, r"(?s)^<\|.*?\|>\n", "")).alias("text")))


def conversation_records(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows by turn into one union record per conversation: two and three turns of the usual roles take the prompt layouts, the rest messages."""
    rows = df.select(col(conv).alias("conv_id"), F.struct(col(turn).cast("long").alias("n"), F.coalesce(col(role), F.lit("")).alias("role"), F.coalesce(col(text), F.lit("")).alias("content")).alias("m"))
    one = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("m")).alias("ms"))
    roles = F.array_join(F.transform("ms", lambda m: m["role"]), ",")
    at = lambda i: F.col("ms")[i]["content"]
    whole = F.forall("ms", lambda m: m["content"] != "")
    pair, triple = whole & (roles == "user,assistant") & (F.size("ms") == 2), whole & (roles == "system,user,assistant") & (F.size("ms") == 3)
    fields = {
        "messages": F.when(~(pair | triple), F.transform("ms", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))),
        "system": F.when(triple, at(0)),
        "prompt": F.when(pair, at(0)).when(triple, F.get(F.col("ms"), F.lit(1))["content"]),
        "response": F.when(pair, F.get(F.col("ms"), F.lit(1))["content"]).when(triple, F.get(F.col("ms"), F.lit(2))["content"]),
    }
    return one.select("conv_id", F.struct(*[c.alias(n) for n, c in fields.items()]).alias("record"))


def format_conversations(df: DataFrame) -> DataFrame:
    """conv_id, fingerprint, layout, turns, segments, formatted."""
    return render(canonical_turns(conversation_records(df), "record")).drop("record")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = spark.createDataFrame([(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")], "conv_id long, turn long, role string, text string")
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    made = format_conversations(rows)
    loss = unescape(F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: s["text"]), ""))
    back = made.select("conv_id", parse(F.col("formatted")).alias("turns"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"), "layout")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


OP4_SQL = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, role || chr(10) || text || chr(10) AS said,
    11 + 1 + length(replace(replace(replace(replace(role, '\', '\s'), '<', '\l'), '[', '\b'), '|', '\p')) + length(replace(replace(replace(text, '\', '\s'), '<', '\l'), '[', '\b')) + 1 AS chars
  FROM r
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(said, '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

QUERIES = {"op4_chat_format": op4_chat_format}
ORACLES = {"op4_chat_format": OP4_SQL}
