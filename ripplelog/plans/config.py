"""Mappings from JSON or YAML text."""

from __future__ import annotations

import json
from collections.abc import Mapping


def parse_mapping(text: str, kind: str = "json") -> dict:
    """A mapping; YAML needs the yaml package, and a list of single mappings counts as one."""
    if kind == "json":
        found = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as e:
            raise RuntimeError("mappings in YAML need the yaml package") from e
        found = yaml.safe_load(text)
    return {k: v for part in found for k, v in part.items()} if isinstance(found, list) else found


def mapping_text(mapping: Mapping, kind: str = "json") -> str:
    """A mapping as discovery writes it, to be edited. In YAML without the yaml package it is JSON, which YAML can read."""
    if kind == "yaml":
        try:
            import yaml
        except ImportError:
            pass
        else:
            return yaml.safe_dump(dict(mapping), sort_keys=False)
    return json.dumps(mapping, indent=2)
