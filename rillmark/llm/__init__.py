"""Operators of a training-data pipeline: one module per operator, queries in ``queries``.

Functions that run inside tasks are shipped with their code, so executors need not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
