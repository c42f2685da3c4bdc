"""Registered queries over the given tables, one module per operator family."""

import importlib
import pkgutil

from skygrid.workload.registry import ORACLE, QUERIES

for _module in pkgutil.iter_modules(__path__):
    importlib.import_module(f"{__name__}.{_module.name}")

__all__ = ["ORACLE", "QUERIES"]
