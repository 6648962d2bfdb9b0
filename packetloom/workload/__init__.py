"""Registered queries: every operator over the given tables, with the same answer in SQL."""

from __future__ import annotations

import importlib

MODULES = ("timeline", "signals", "windows", "views", "layouts", "labels", "links", "checks", "subsets", "paths", "files", "streams", "runs")


def load(kind: str) -> dict:
    out: dict = {}
    for name in MODULES:
        part = getattr(importlib.import_module(f"packetloom.workload.{name}"), kind)
        clash = set(out) & set(part)
        if clash:
            raise ValueError(f"query registered twice: {sorted(clash)}")
        out.update(part)
    return out
