"""Operators of a large-scale training-data pipeline.

Nothing outside this package imports it except the guarded lines of
``__spark_entry__.py`` and ``corpus_pipeline.py``. Functions that run in
Python workers are shipped by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
