"""Training-data operators. Functions sent to executors travel by value, so no package copy is needed there."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
