"""Operators of a training-data pipeline over documents and web pages.

Nothing else in the library imports this subpackage.  Each module holds one
operator with a general interface; ``queries`` registers the thin per-table
queries and ``oracle`` their SQL.  Functions that run inside tasks are shipped
by value, so executors need no copy of the package.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
