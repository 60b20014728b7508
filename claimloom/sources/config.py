"""Configuration: defaults with deep overrides."""

from __future__ import annotations


def deep_merge(base: dict, over: dict) -> dict:
    """Dictionaries are merged level by level; scalars and lists of ``over`` replace those of ``base``."""
    out = dict(base)
    for k, v in (over or {}).items():
        out[k] = deep_merge(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out
