"""Where each layer of a run is stored."""

from __future__ import annotations

import re

_SEGMENT = re.compile(r"[A-Za-z0-9._-]+")


def run_path(root: str, layer: str, run_id: str, *parts: str) -> str:
    """``root/layer/run/part/...``; a run id may not leave its folder."""
    for segment in (layer, run_id, *parts):
        if not _SEGMENT.fullmatch(segment) or set(segment) == {"."}:
            raise ValueError(f"not a plain path segment: {segment!r}")
    return "/".join([root.rstrip("/"), layer, run_id, *parts])
