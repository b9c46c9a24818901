"""Operators for preparing training data: one module per operator.

Nothing outside this folder, ``corpus_pipeline.py`` and ``tests/llm`` imports
it. Every operator is a DataFrame -> DataFrame function with its own options;
``cohortkit.llm.queries`` binds them to the registered queries.

Functions that run inside Python workers are shipped by value, so executors
need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
