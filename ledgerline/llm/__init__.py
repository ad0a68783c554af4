"""Operators for preparing language-model training data; nothing else in the library imports this folder.

Functions of this folder travel to the executors with their code, so that the workers need no copy of it on
their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
