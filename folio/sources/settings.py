"""Settings and the tool catalogue, read on the driver."""

from __future__ import annotations

from dataclasses import dataclass, fields
from pathlib import Path

from folio.functions import fixed as K

_YES, _NO = ("1", "true", "yes", "y", "on"), ("0", "false", "no", "n", "off")


def as_bool(value, default: bool) -> bool:
    if isinstance(value, bool):
        return value
    word = value.strip().lower() if isinstance(value, str) else ""
    return True if word in _YES else False if word in _NO else default


def as_number(kind: type, value, default):
    try:
        return kind(value)
    except (TypeError, ValueError):
        return default


@dataclass(frozen=True)
class ModelSettings:
    enabled: bool = False
    base_url: str = ""
    api_key: str = ""
    model: str = ""
    timeout_seconds: int = 120
    max_tokens: int = 4096
    temperature: float = 0.1
    max_attempts: int = K.MODEL_ATTEMPTS
    max_wait_seconds: float = 30.0


@dataclass(frozen=True)
class DraftSettings:
    max_chars: int = K.MAX_CHARS
    context_chars: int = K.CONTEXT_CHARS
    outline_max_sections: int = K.OUTLINE_SECTIONS


def _mapping(path: str | None) -> dict:
    import yaml

    if not path or not Path(path).exists():
        return {}
    data = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    return data if isinstance(data, dict) else {}


def _filled(cls, raw):
    raw = raw if isinstance(raw, dict) else {}
    out = {}
    for f in fields(cls):
        v, d = raw.get(f.name), f.default
        out[f.name] = as_bool(v, d) if isinstance(d, bool) else str(v or "") if isinstance(d, str) else as_number(type(d), v, d)
    return cls(**out)


def model_settings(path: str | None = None) -> ModelSettings:
    return _filled(ModelSettings, _mapping(path).get("llm"))


def draft_settings(path: str | None = None) -> DraftSettings:
    return _filled(DraftSettings, _mapping(path).get("draft"))


def read_tools(path: str | None) -> list[dict]:
    """The tools of a YAML file, a list or one under `tools`; a file that is missing or broken has none."""
    import yaml

    try:
        data = yaml.safe_load(Path(path).read_text(encoding="utf-8")) if path else None
    except (FileNotFoundError, yaml.YAMLError):
        return []
    data = data.get("tools") if isinstance(data, dict) else data
    return [t for t in data if isinstance(t, dict)] if isinstance(data, list) else []


def read_spec(path: str | None) -> str:
    """The text of a format specification for the model, "" without one."""
    return Path(path).read_text(encoding="utf-8").strip() if path and Path(path).exists() else ""
