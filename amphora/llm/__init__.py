"""Operators for preparing training text at scale.

Each module holds one operator and its docstring states what it does with
nulls, empty and very long texts, ties, repeated rows and extra columns. The
registered queries are in ``queries`` and their SQL twins in ``sql``.
"""

import sys

try:  # executors need not have this package installed
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
except (ImportError, AttributeError, ValueError):  # an older cloudpickle imports by name
    pass
