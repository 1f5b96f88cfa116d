"""Operators for building training corpora: quality rules, near-duplicates, URL lists, HTML text,
secrets, language, repeated passages, packing, benchmark leaks and shards.

Each module holds one operator with its own general interface; :mod:`tripstar.llm.registry` holds
the thin registered queries. Nothing outside this package imports it.
"""

import sys

from pyspark import cloudpickle

# Task code travels with the task: executors need not have this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
