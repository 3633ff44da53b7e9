"""Sends the code of this subpackage with each job, so executors need no installed copy of it."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

_PACKAGE = __name__.rpartition(".")[0]


def shipped(module_name: str) -> None:
    """Pickle the functions of a module by value. Modules of this subpackage call it with their own name."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


shipped(__name__)
