"""Operators of a training-data pipeline. Nothing outside this subpackage imports it.

Functions that run inside tasks travel with their code, so executors need not have the repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
