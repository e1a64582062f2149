"""Default style rules, and overlays on them."""

from __future__ import annotations

from pathlib import Path
from typing import Any

from ..operators.styles import merged


def load_rules(path: str | Path | None = None) -> dict[str, Any]:
    """The YAML rules at ``path``, by default the library's; the root must be a mapping."""
    import yaml

    data = yaml.safe_load(Path(path or Path(__file__).with_name("rules.yaml")).read_text(encoding="utf-8"))
    if not isinstance(data, dict):
        raise TypeError("the rules' root is no mapping")
    return data


def rules(overlay: str | Path | dict[str, Any] | None = None) -> dict[str, Any]:
    """Default rules with an overlay (a file or a mapping) merged over them."""
    over = overlay if isinstance(overlay, dict) else load_rules(overlay) if overlay else {}
    return merged(load_rules(), over)
