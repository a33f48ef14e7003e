"""Declarative configuration: entity types, fields, merge strategies, match rules.

The tables below are fixed values: they name the fields and rules that results depend on.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields

PRESERVE, APPEND, REPLACE, BETTER, AGENT = "preserve_existing", "append_unique", "replace_always", "replace_if_better", "agent_only"

# Scalar and array fields of each entity type besides the common ones.
COMMON_SCALARS = ("name", "cleanDescription", "lastUpdated")
COMMON_ARRAYS = ("aliases", "rawDescriptions", "permissions", "sources")
ENTITY_FIELDS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "Person": (("sourceSystemId", "worksAt"), ("emails", "role")),
    "Team": ((), ()),
    "Organization": (("domain", "industry"), ("location",)),
    "Project": (("status", "startDate", "endDate", "client"), ("tags",)),
    "Repository": (("url", "language"), ()),
    "Branch": (("repo", "createdBy", "createdAt"), ()),
    "CodeChangeRequest": (("title", "status", "author", "repo", "branch", "createdAt", "mergedAt"), ("reviewers",)),
    "Issue": (("id", "status", "reporter", "createdAt", "closedAt"), ("assignees", "labels")),
    "Event": (("eventType", "startTime", "linkedProject"), ()),
    "Topic": ((), ("keywords", "relatedThreads")),
}
DATE_FIELDS = ("startDate", "endDate")
# Extracted field -> stored field, by type ("*" for all).
FIELD_MAPPINGS = {"*": {"description": "rawDescriptions"}, "Person": {"email": "emails"}, "Event": {"title": "name", "type": "eventType"}}
# Strategies that differ from "append_unique" for arrays and "preserve_existing" for scalars.
STRATEGIES = {("Person", "emails"): PRESERVE, ("Organization", "industry"): BETTER, ("Repository", "language"): BETTER, ("Project", "status"): REPLACE, ("CodeChangeRequest", "status"): REPLACE, ("Issue", "status"): REPLACE, ("*", "embedding"): REPLACE, ("*", "lastUpdated"): REPLACE}
# Fields that the extractor is asked for.
PROMPT_FIELDS = {
    "Person": ("name", "email", "role", "aliases", "sourceSystemId", "description", "worksAt"),
    "Team": ("name", "description"),
    "Organization": ("name", "domain", "description", "industry", "location"),
    "Project": ("name", "description", "status", "startDate", "endDate", "client", "tags"),
    "Repository": ("name", "url", "description"),
    "Branch": ("name", "repo", "createdBy", "createdAt"),
    "CodeChangeRequest": ("name", "description", "status", "author", "createdAt", "mergedAt", "repo", "branch"),
    "Issue": ("name", "title", "description", "status", "reporter", "labels", "createdAt", "closedAt"),
    "Event": ("id", "title", "description", "type", "startTime", "linkedProject"),
    "Topic": ("id", "name", "keywords", "relatedThreads"),
}


@dataclass(frozen=True)
class Rule:
    entity_type: str
    kind: str  # exact | search
    match: str
    db: str
    priority: int
    confidence: float


def _rules(entity_type: str, *rows: tuple) -> list[Rule]:
    return [Rule(entity_type, kind, match, db, i + 1, conf) for i, (kind, match, db, conf) in enumerate(rows)]


# Match rules in priority order.
RULES: list[Rule] = [
    *_rules("Person", ("search", "email", "emails", 0.90), ("exact", "name", "name", 0.95), ("search", "alias", "aliases", 0.80), ("exact", "sourceSystemId", "sourceSystemId", 0.85)),
    *_rules("Team", ("exact", "name", "name", 0.90), ("search", "alias", "aliases", 0.75)),
    *_rules("Organization", ("exact", "domain", "domain", 0.95), ("exact", "name", "name", 0.80), ("search", "alias", "aliases", 0.70)),
    *_rules("Project", ("exact", "name", "name", 0.85), ("search", "alias", "aliases", 0.70)),
    *_rules("Repository", ("exact", "url", "url", 0.95), ("exact", "name", "name", 0.70)),
    *_rules("Branch", ("exact", "name", "name", 0.80), ("exact", "repo", "repo", 0.75)),
    *_rules("CodeChangeRequest", ("exact", "name", "name", 0.95), ("exact", "title", "title", 0.80)),
    *_rules("Issue", ("exact", "name", "name", 0.95), ("exact", "id", "id", 0.90)),
    *_rules("Event", ("exact", "name", "name", 0.85)),
    *_rules("Topic", ("exact", "name", "name", 0.80), ("search", "alias", "aliases", 0.65)),
]
#: The same rules without the one that joins all branches of a repository.
SAFE_RULES = [r for r in RULES if (r.entity_type, r.match) != ("Branch", "repo")]
FALLBACK_CONFIDENCE = 0.70


@dataclass
class Config:
    """Accessors over the tables; pass other tables to change types, strategies or rules."""

    fields: dict = field(default_factory=lambda: dict(ENTITY_FIELDS))
    mappings: dict = field(default_factory=lambda: dict(FIELD_MAPPINGS))
    strategies: dict = field(default_factory=lambda: dict(STRATEGIES))
    rules: list[Rule] = field(default_factory=lambda: list(RULES))
    prompt_fields: dict = field(default_factory=lambda: dict(PROMPT_FIELDS))
    embedding_dim: int = 1024

    @classmethod
    def from_yaml(cls, path: str) -> Config:
        """Keys of the file replace the tables of the same name; rules are mappings with Rule's fields.

        Files that describe types one by one are read too: ``entity_schemas`` has a type's extracted fields (``llm_fields``) and its stored
        ones (``mappings``: field to type, merge_strategy and the extracted field), ``systematic_merge.matching_rules`` a type's rules.
        """
        import yaml

        with open(path, encoding="utf-8") as f:
            raw = yaml.safe_load(f) or {}
        out = cls(**{k: v for k, v in raw.items() if k in ("mappings", "prompt_fields", "embedding_dim")})
        if "fields" in raw:
            out.fields = {t: (tuple(v.get("scalars", ())), tuple(v.get("arrays", ()))) for t, v in raw["fields"].items()}
        if "strategies" in raw:
            out.strategies = {(t, f): s for t, fs in raw["strategies"].items() for f, s in fs.items()}
        if "rules" in raw:
            out.rules = [Rule(r["entity_type"], r["kind"], r["match"], r.get("db", r["match"]), r.get("priority", 999), r.get("confidence", 0.0)) for r in raw["rules"]]
        if types := raw.get("entity_schemas"):
            stored = {t: v.get("mappings", {}) for t, v in types.items()}
            strings = {t: [f for f, m in fs.items() if "[" not in m.get("type", "STRING")] for t, fs in stored.items()}
            lists = {t: [f for f, m in fs.items() if m.get("type") == "STRING[]"] for t, fs in stored.items()}
            out.fields = {t: (tuple(f for f in strings[t] if f not in COMMON_SCALARS), tuple(f for f in lists[t] if f not in COMMON_ARRAYS)) for t in stored}
            out.prompt_fields = {t: tuple(v.get("llm_fields", ())) for t, v in types.items()}
            out.mappings = {t: {m["mapping"]: f for f, m in fs.items() if m.get("mapping", f) != f} for t, fs in stored.items()}
            out.strategies = {(t, f): m["merge_strategy"] for t, fs in stored.items() for f, m in fs.items() if "merge_strategy" in m}
        if rules := raw.get("systematic_merge", {}).get("matching_rules"):
            out.rules = [Rule(t, r["rule"], r["match"], r.get("db", r["match"]), r.get("priority", 999), r.get("confidence", 0.0)) for t, rs in rules.items() for r in rs]
        return out

    def entity_types(self) -> list[str]:
        return list(self.fields)

    def scalars(self, t: str) -> list[str]:
        return [*COMMON_SCALARS, *self.fields[t][0]]

    def arrays(self, t: str) -> list[str]:
        return [*COMMON_ARRAYS, *self.fields[t][1]]

    def target(self, t: str, extracted: str) -> str:
        return self.mappings.get(t, {}).get(extracted) or self.mappings.get("*", {}).get(extracted, extracted)

    def strategy(self, t: str, f: str) -> str:
        default = APPEND if f in self.arrays(t) else PRESERVE
        return self.strategies.get((t, f)) or self.strategies.get(("*", f), default)

    def mergeable(self, t: str, f: str, from_agent: bool = False) -> bool:
        return from_agent or self.strategy(t, f) != AGENT

    def rules_of(self, t: str) -> list[Rule]:
        return sorted((r for r in self.rules if r.entity_type == t), key=lambda r: r.priority)

    def all_scalars(self) -> list[str]:
        return list(dict.fromkeys(f for t in self.fields for f in self.scalars(t)))

    def all_arrays(self) -> list[str]:
        return list(dict.fromkeys(f for t in self.fields for f in self.arrays(t)))


@dataclass
class Settings:
    """Settings of a run, from the environment: ``ENTITYFLOW_`` and the field's name in capitals."""

    endpoint: str = "http://localhost:8080"
    schema: str = "mail"
    namespace: str = "default"
    cluster: str = "content"
    base: str = "graph"
    progress: str = "graph/_progress"
    output: str = "graph/_output"
    batch_size: int = 5
    max_documents: int = 1000
    page_size: int = 100
    parallel_calls: int = 10
    max_hits: int = 100
    request_timeout: int = 120
    connection_timeout: int = 10
    read_timeout: int = 30
    max_retries: int = 3
    retry_failed: bool = False
    save_results: bool = True
    detect_data_type: bool = False

    @classmethod
    def from_env(cls, environ: dict | None = None) -> Settings:
        env = os.environ if environ is None else environ
        found = {}
        for f in fields(cls):
            raw = env.get(f"ENTITYFLOW_{f.name.upper()}")
            if raw is not None:
                try:
                    found[f.name] = int(raw) if f.type == "int" else raw.strip().lower() in ("1", "true", "yes") if f.type == "bool" else raw
                except ValueError:
                    raise ValueError(f"{f.name} must be a whole number, not {raw!r}") from None
        out = cls(**found)
        if problem := out.problem():
            raise ValueError(problem)
        return out

    def problem(self) -> str | None:
        """What is wrong with the settings, if anything: numbers are greater than 0."""
        return next((f"{f.name} must be greater than 0" for f in fields(self) if f.type == "int" and getattr(self, f.name) <= 0), None)
