"""Operators of a training-data pipeline; nothing else in the package imports this folder.

Functions that run inside tasks travel with the job, so executors need the libraries only,
not a copy of this folder.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
