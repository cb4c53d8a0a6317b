"""Settings as frozen dataclasses; ``from_dict`` takes what a YAML or JSON file holds and refuses unknown names."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, is_dataclass
from pathlib import Path

from narrata.functions import text
from narrata.operators import extraction, linking


@dataclass(frozen=True)
class Documents:
    text_fields: tuple[str, ...] = text.TEXT_FIELDS
    #: Fields of the context.
    context_fields: tuple[str, ...] = ("cleaned_title", "cleaned_excerpt", "cleaned_author", "cleaned_publication_date", "cleaned_categories", "cleaned_tags")
    max_text_length: int = text.MAX_TEXT
    max_batch: int = 10_000
    preserved_fields: tuple[str, ...] = text.PRESERVED_FIELDS


@dataclass(frozen=True)
class Extraction:
    least_confidence: float = extraction.LEAST_CONFIDENCE
    chunk_tokens: int = 2048
    chunk_overlap: int = 256
    relations: tuple[str, ...] = extraction.RELATIONS
    least_triplet_confidence: float = 0.6


@dataclass(frozen=True)
class Calls:
    attempts: int = 3
    base_seconds: float = 2.0
    most_seconds: float = 60.0
    failures_to_open: int = 5
    open_seconds: float = 60.0
    cache_seconds: int = 3600


@dataclass(frozen=True)
class Settings:
    documents: Documents = field(default_factory=Documents)
    extraction: Extraction = field(default_factory=Extraction)
    linking: linking.Weights = field(default_factory=linking.Weights)
    calls: Calls = field(default_factory=Calls)
    link_events: bool = True


def from_dict(values: dict, kind: type = Settings):
    known = {f.name: f for f in fields(kind)}
    if unknown := set(values) - set(known):
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    built = {}
    for name, value in values.items():
        default = getattr(kind(), name)
        if isinstance(default, bool):
            value = str(value).strip().lower() in ("1", "true", "yes", "on")
        built[name] = from_dict(value, type(default)) if is_dataclass(default) else tuple(value) if isinstance(default, tuple) else type(default)(value)
    return kind(**built)


def expanded(value, names: Mapping[str, str] = os.environ):
    """``value`` with ${NAME} and ${NAME:default} in its strings replaced, at any depth; a name without a value stays."""
    if isinstance(value, dict):
        return {k: expanded(v, names) for k, v in value.items()}
    if isinstance(value, list):
        return [expanded(v, names) for v in value]
    if isinstance(value, str):
        return re.sub(r"\$\{([^}:]+)(?::([^}]*))?\}", lambda m: names.get(m[1], m[2] if m[2] is not None else m[0]), value)
    return value


def from_file(path: str, names: Mapping[str, str] = os.environ) -> Settings:
    """Settings from a JSON file, or from a YAML file where a YAML reader is installed."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith((".yaml", ".yml")):
        import yaml

        return from_dict(expanded(yaml.safe_load(text) or {}, names))
    return from_dict(expanded(json.loads(text), names))
