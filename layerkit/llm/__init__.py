"""Operators of a training-data pipeline (dedup, quality, tokens, PII, mixing, toxicity, licences).

The Python steps are sent to the executors by value, so nothing has to be installed there but
PySpark, NumPy, PyArrow and the libraries a step uses.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
