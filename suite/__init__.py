"""Registered queries: each operator on the sample tables, with its SQL twin."""

from __future__ import annotations

import sys
from importlib import import_module
from pkgutil import iter_modules

from pyspark import cloudpickle

from suite.registry import Suite

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the sample forecast model runs in executors


def build_suite() -> Suite:
    suite = Suite()
    for module in sorted(m.name for m in iter_modules(__path__) if m.name.endswith("_suite")):
        import_module(f"suite.{module}").register(suite)
    return suite
