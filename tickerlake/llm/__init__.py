"""Training-data operators: filters, near-duplicates, mixing, packing, formats.

Nothing outside this subpackage imports it. Functions that run inside Spark
tasks travel by value, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
