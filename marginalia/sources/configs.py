"""Small configuration inputs: agents, fixtures, baselines, retrieval settings.

These are human-written files of bounded size; they are read on the driver,
checked, and turned into relations that join with the data.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

try:
    import yaml
except ImportError:  # YAML inputs are then unavailable; JSON ones still work
    yaml = None

# Chunk reference form, supported versions, defaults.
CHUNK_REFERENCE = re.compile(r"[A-Za-z0-9_\-]+/ch_\d{4}")
FIXTURE_VERSION = 1
BASELINE_VERSIONS = (1, 2)
DEFAULT_PERSONA = {"style": "", "expertise": [], "greeting": ""}
DEFAULT_HYBRID = {"enabled": False, "pool_size": 50, "k_rrf": 60}
DEFAULT_RERANK = {"enabled": False, "model": "BAAI/bge-reranker-base", "pool_size": 50, "batch_size": 16}


class ConfigError(ValueError):
    """A configuration file that cannot be used, with the place that is wrong."""


# What a run can be asked for; the first of each is the default.
RUN_CHOICES = {
    "parser": ("unstructured", "omr", "hybrid"),
    "ocr_mode": ("auto", "on", "off"),
    "music_format": ("musicxml", "abc", "midi", "all"),
    "vector_db": ("faiss",),
    "formula_format": ("latex", "mathml", "both"),
}
SCORE_PARSERS = ("omr", "hybrid")


def run_options(chunk_size: int = 1200, chunk_overlap: int = 150, music_embeddings: bool = False, **chosen: str) -> dict:
    """Options of a run with their defaults filled in, or a ConfigError that lists all faults.

    Names of ``chosen`` are those of RUN_CHOICES; ocr_mode may be in any case.
    """
    faults = [f"unknown option {name!r}" for name in chosen if name not in RUN_CHOICES]
    options = {name: chosen.get(name, choices[0]) for name, choices in RUN_CHOICES.items()}
    options["ocr_mode"] = str(options["ocr_mode"]).lower()
    faults += [f"{name}: {options[name]!r} is none of {', '.join(choices)}" for name, choices in RUN_CHOICES.items() if options[name] not in choices]
    if chunk_overlap >= chunk_size:
        faults.append(f"chunk_overlap: {chunk_overlap} must be less than chunk_size {chunk_size}")
    if music_embeddings and options["parser"] not in SCORE_PARSERS:
        faults.append(f"music_embeddings: needs parser {' or '.join(SCORE_PARSERS)}, not {options['parser']}")
    if faults:
        raise ConfigError("; ".join(faults))
    return options | {"chunk_size": chunk_size, "chunk_overlap": chunk_overlap, "music_embeddings": music_embeddings}


def load_yaml(path: str | Path) -> object:
    if yaml is None:
        raise ConfigError("PyYAML is not installed")
    try:
        return yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    except FileNotFoundError as problem:
        raise ConfigError(f"{path}: file not found") from problem
    except yaml.YAMLError as problem:
        raise ConfigError(f"{path}: not valid YAML") from problem


@dataclass(frozen=True)
class AgentConfig:
    name: str
    description: str = ""
    slugs: list[str] | None = None
    collections: list[str] | None = None
    exclude_slugs: list[str] | None = None
    persona: dict = field(default_factory=dict)


def load_agent(name: str, folder: str | Path) -> AgentConfig:
    path = Path(folder) / f"{name}.yaml"
    raw = load_yaml(path)
    if not isinstance(raw, dict) or "name" not in raw:
        raise ConfigError(f"{path}: an agent needs a mapping with a name")
    rules = raw.get("corpus_filter")
    rules = rules if isinstance(rules, dict) else {}
    persona = raw.get("persona")
    return AgentConfig(
        raw["name"],
        raw.get("description") or "",
        rules.get("slugs"),
        rules.get("collections"),
        rules.get("exclude_slugs"),
        persona if isinstance(persona, dict) else {},
    )


def load_persona(name: str, folder: str | Path) -> dict:
    """Name and persona of an agent, every key present; an agent without a file has the defaults.

    With a file the description and an icon belong to it, empty if not given.
    """
    path = Path(folder) / f"{name}.yaml"
    plain = {"name": name} | {key: value.copy() if isinstance(value, list) else value for key, value in DEFAULT_PERSONA.items()}
    if not path.exists():
        return plain
    raw = load_yaml(path)
    if not isinstance(raw, dict):
        raise ConfigError(f"{path}: an agent needs a mapping")
    persona = raw.get("persona")
    given = persona if isinstance(persona, dict) else {}
    own = {key: given[key] for key in (*DEFAULT_PERSONA, "icon") if key in given}
    return plain | {"description": raw.get("description", ""), "icon": ""} | own


def agent_relations(spark: SparkSession, agents: list[AgentConfig]) -> tuple[DataFrame, ...]:
    """agents, agent_collections, agent_slugs, agent_excludes."""

    def pairs(attribute: str, column: str) -> DataFrame:
        rows = [(a.name, v) for a in agents for v in getattr(a, attribute) or []]
        return spark.createDataFrame(rows, f"agent string, {column} string")

    names = spark.createDataFrame([(a.name,) for a in agents], "agent string")
    return names, pairs("collections", "collection"), pairs("slugs", "slug"), pairs("exclude_slugs", "slug")


def _text(value: object, where: str) -> str:
    if not isinstance(value, str) or not value.strip():
        raise ConfigError(f"{where}: needs a non-empty string")
    return value


def _texts(value: object, where: str) -> list[str]:
    if value is None:
        return []
    if not isinstance(value, list):
        raise ConfigError(f"{where}: needs a list")
    return [_text(entry, where) for entry in value]


def _page(value: object, where: str) -> tuple[int, int] | tuple[None, None]:
    """Page or page pair as a range; True and False are no numbers here."""
    if value is None:
        return None, None
    ends = value if isinstance(value, list) else [value, value]
    whole = all(isinstance(e, int) and not isinstance(e, bool) and e >= 1 for e in ends)
    if len(ends) != 2 or not whole or ends[0] > ends[1]:
        raise ConfigError(f"{where}: needs a page from 1 or an ordered pair of pages")
    return ends[0], ends[1]


def load_fixture(spark: SparkSession, path: str | Path, agents: str | Path | None = None) -> dict[str, DataFrame]:
    """Checked fixture as relations: items, expected, expected_chunks, tags.

    ``agents`` names the agent folder; the fixture's agent must be in it."""
    raw = load_yaml(path)
    if not isinstance(raw, dict):
        raise ConfigError(f"{path}: needs a mapping")
    agent = _text(raw.get("agent"), f"{path}: agent")
    if agents is not None:
        load_agent(agent, agents)
    if isinstance(raw.get("version"), bool) or raw.get("version") != FIXTURE_VERSION:
        raise ConfigError(f"{path}: version must be {FIXTURE_VERSION}")
    entries = raw.get("items")
    if not isinstance(entries, list) or not entries:
        raise ConfigError(f"{path}: items must be a non-empty list")
    items, expected, chunks, tags = [], [], [], []
    seen: set[str] = set()
    for position, entry in enumerate(entries):
        where = f"{path}: item {position}"
        if not isinstance(entry, dict):
            raise ConfigError(f"{where}: needs a mapping")
        item = _text(entry.get("id"), f"{where}: id")
        where = f"{path}: {item}"
        if item in seen:
            raise ConfigError(f"{where}: duplicate item id")
        seen.add(item)
        question = _text(entry.get("query"), f"{where}: query")
        want = entry.get("expected")
        if not isinstance(want, dict):
            raise ConfigError(f"{where}: expected is missing")
        docs = _texts(want.get("doc_ids"), f"{where}: expected.doc_ids")
        if not docs:
            raise ConfigError(f"{where}: expected.doc_ids must not be empty")
        for reference in _texts(want.get("chunk_ids"), f"{where}: expected.chunk_ids"):
            if not CHUNK_REFERENCE.fullmatch(reference):
                raise ConfigError(f"{where}: chunk id {reference!r} is not <doc>/ch_NNNN")
            doc, number = reference.split("/ch_")
            chunks.append((item, doc, int(number)))
        start, end = _page(want.get("page"), f"{where}: expected.page")
        section = want.get("section")
        if section is not None:
            _text(section, f"{where}: expected.section")
        if not isinstance(entry.get("notes", ""), str):
            raise ConfigError(f"{where}: notes must be a string")
        items.append((item, question, start, end, section))
        expected += [(item, doc) for doc in docs]
        tags += [(item, tag) for tag in _texts(entry.get("tags"), f"{where}: tags")]
    make = spark.createDataFrame
    return {
        "items": make(items, "item_id string, query string, expected_page_start int, expected_page_end int, expected_section string"),
        "expected": make(expected, "item_id string, doc_id string"),
        "expected_chunks": make(chunks, "item_id string, doc_id string, chunk_index int"),
        "tags": make(tags, "item_id string, tag string"),
    }


def load_baseline(path: str | Path) -> dict:
    """Aggregate of a stored run. Version 1 has no citation figures."""
    try:
        raw = json.loads(Path(path).read_text(encoding="utf-8"))
    except FileNotFoundError as problem:
        raise ConfigError(f"{path}: file not found") from problem
    except json.JSONDecodeError as problem:
        raise ConfigError(f"{path}: not valid JSON") from problem
    if not isinstance(raw, dict) or raw.get("format_version") not in BASELINE_VERSIONS:
        raise ConfigError(f"{path}: unsupported format_version")
    if "agent" not in raw or not isinstance(raw.get("aggregate"), dict):
        raise ConfigError(f"{path}: agent and aggregate are required")
    return {"citation_accuracy": None, "n_citation_items": 0} | raw["aggregate"]


def load_retrieval(path: str | Path | None) -> dict:
    """Retrieval settings; anything missing or unreadable means no settings."""
    if path is None:
        return {}
    try:
        raw = load_yaml(path)
    except (ConfigError, OSError):
        return {}
    block = raw.get("retrieval") if isinstance(raw, dict) else None
    return block if isinstance(block, dict) else {}


def resolve(defaults: dict, settings: dict, section: str, enabled: bool = False, **given) -> dict:
    """Explicit values over file values over defaults; either may enable."""
    stored = settings.get(section)
    stored = stored if isinstance(stored, dict) else {}
    merged = {**defaults, **{k: v for k, v in stored.items() if k in defaults}}
    merged |= {k: v for k, v in given.items() if v is not None}
    merged["enabled"] = bool(enabled) or bool(stored.get("enabled", False))
    for key in ("pool_size", "k_rrf", "batch_size"):
        if key in merged:
            merged[key] = int(merged[key])
            if merged[key] < 1:
                raise ConfigError(f"{section}.{key} must be at least 1")
    return merged
