"""Operators for preparing training text at corpus scale.

Nothing outside this package imports it. Every operator is a function from
DataFrame to DataFrame; ``registry`` holds the thin queries over whole tables.

Functions that run in Python workers travel with their code, so executors need no
copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
