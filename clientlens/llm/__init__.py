"""Training-data operators: one module per operator, ``queries.py`` for the
registered queries and their SQL. Nothing outside this package imports it.

Functions that run in tasks travel with the job, so executors need no copy of
the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
