"""Registered queries over the driver tables, each with its SQL where one exists."""

from __future__ import annotations

import importlib

from . import registry

AREAS = ("selection", "texts", "indexes", "transcripts", "records", "meetings", "streams")


def _load_areas() -> None:
    for area in AREAS:
        importlib.import_module(f"{__name__}.{area}")


def queries() -> dict[str, registry.Query]:
    _load_areas()
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_areas()
    return dict(registry.SQL)
