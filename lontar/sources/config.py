"""Options of a run: a tree from a JSON or YAML file, overridden by typed environment variables."""

from __future__ import annotations

import json
import os
from typing import Any

#: Environment variables and the places they set (a prefix of our own).
OVERRIDES = {
    "LONTAR_CONCURRENCY": "crawler.concurrency", "LONTAR_DELAY": "crawler.delay_seconds", "LONTAR_RETRIES": "crawler.max_retries", "LONTAR_TIMEOUT": "crawler.timeout_seconds", "LONTAR_USER_AGENT": "crawler.user_agent",
    "LONTAR_MIN_LENGTH": "content.min_length", "LONTAR_REMOVE_EMOJI": "content.remove_emojis", "LONTAR_CONFIDENCE": "classification.min_confidence", "LONTAR_SIMILARITY": "deduplication.similarity", "LONTAR_HAMMING": "deduplication.hamming_distance",
    "LONTAR_RETENTION_DAYS": "deduplication.retention_days", "LONTAR_SHARD_SIZE": "export.shard_size", "LONTAR_OUT_DIR": "export.out_dir", "LONTAR_VERSION": "export.delivery_version", "LONTAR_MAX_PAGES": "limits.max_pages",
    "LONTAR_MAX_HOURS": "limits.max_hours", "LONTAR_BATCH": "limits.batch_size", "LONTAR_LOG_LEVEL": "logging.level", "LONTAR_CHECKPOINT_PAGES": "limits.checkpoint_pages", "LONTAR_CLEANUP_PAGES": "limits.cleanup_pages",
}
DEFAULTS = {
    "crawler": {"concurrency": 64, "max_retries": 3, "delay_seconds": 1.0}, "content": {"min_length": 200, "remove_emojis": True}, "classification": {"min_confidence": 0.3},
    "deduplication": {"hamming_distance": 3, "similarity": 0.95, "retention_days": 30}, "export": {"shard_size": 10_000, "out_dir": "out", "delivery_version": "v1"}, "limits": {"batch_size": 10, "checkpoint_pages": 1_000, "cleanup_pages": 10_000},
}


def typed(value: str) -> Any:
    """A whole number, else a number, else a truth value, else the text."""
    for kind in (int, float):
        try:
            return kind(value)
        except ValueError:
            pass
    return {"true": True, "false": False}.get(value.lower(), value)


def load(path: str | None = None, environment: dict[str, str] | None = None) -> dict[str, Any]:
    tree = json.loads(json.dumps(DEFAULTS))
    if path:
        with open(path, encoding="utf-8") as f:
            text = f.read()
        if path.endswith((".yaml", ".yml")):
            import yaml  # optional

            loaded = yaml.safe_load(text)
        else:
            loaded = json.loads(text)
        _merge(tree, loaded or {})
    for name, place in OVERRIDES.items():
        value = (os.environ if environment is None else environment).get(name)
        if value is not None:
            put(tree, place, typed(value))
    return tree


def _merge(tree: dict, other: dict) -> None:
    for k, v in other.items():
        if isinstance(v, dict) and isinstance(tree.get(k), dict):
            _merge(tree[k], v)
        else:
            tree[k] = v


def get(tree: dict, place: str, default: Any = None) -> Any:
    for part in place.split("."):
        if not isinstance(tree, dict) or part not in tree:
            return default
        tree = tree[part]
    return tree


def put(tree: dict, place: str, value: Any) -> None:
    *head, last = place.split(".")
    for part in head:
        tree = tree.setdefault(part, {})
    tree[last] = value
