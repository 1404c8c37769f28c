"""Sports event and shift analytics as DataFrame operators."""

import sys

from pyspark import cloudpickle

# Python functions travel to the workers by value, so a cluster needs no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
