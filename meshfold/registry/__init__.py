"""All registered queries."""

from __future__ import annotations

import importlib

MODULES = ("spatial", "relational", "importing", "output", "catalogue")


def load_all():
    from meshfold.registry import core

    for name in MODULES:
        importlib.import_module(f"meshfold.registry.{name}")
    return core.QUERIES, core.ORACLES
