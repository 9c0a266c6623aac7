"""Operators of a training-data pipeline, written for tables far larger than one machine.

Nothing outside this package imports it. Its Python helpers run inside Spark
tasks; they are shipped by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
