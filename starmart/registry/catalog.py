"""All registered queries and oracles."""

from __future__ import annotations

import importlib

GROUPS = ["star", "cube", "scalars", "conforming", "ingest", "loading", "raw", "policies", "checks"]


def _merged(attribute: str) -> dict:
    merged: dict = {}
    for group in GROUPS:
        entries = getattr(importlib.import_module(f"starmart.registry.{group}"), attribute)
        clash = merged.keys() & entries.keys()
        if clash:
            raise ValueError(f"registered twice: {sorted(clash)}")
        merged.update(entries)
    return merged


def queries() -> dict:
    return _merged("QUERIES")


def oracles() -> dict[str, str]:
    return _merged("ORACLES")
