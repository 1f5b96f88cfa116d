"""tripstar: a Spark-native ride-hailing lakehouse (bronze -> silver -> gold star schema).

Every operator is a plain ``DataFrame -> DataFrame`` (or ``Column``) function built from Spark SQL
expressions, so Catalyst plans the whole pipeline end to end.

Entry points (imported lazily)::

    from tripstar import build_session, LakePaths, build_reference, run_pipeline, register_report_views
"""

from __future__ import annotations

import importlib

__version__ = "0.1.0"

_EXPORTS = {
    "build_session": "tripstar.session",
    "LakePaths": "tripstar.paths",
    "build_reference": "tripstar.plans.pipeline",
    "run_pipeline": "tripstar.plans.pipeline",
    "register_report_views": "tripstar.plans.reports",
}

__all__ = sorted(_EXPORTS)


def __getattr__(name: str):
    if name in _EXPORTS:
        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(f"module 'tripstar' has no attribute {name!r}")
