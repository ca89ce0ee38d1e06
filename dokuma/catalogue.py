"""All queries over the reference's own operators, with their SQL."""

from __future__ import annotations

import importlib

from .plans.base import QUERIES, SQL, Query

for _m in ("core", "browsing", "texts", "measures", "sound", "store", "files", "joins", "integrity", "stages"):
    importlib.import_module(f".plans.{_m}", __package__)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
