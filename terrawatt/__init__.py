"""terrawatt: PySpark-native analytics for metering, geospatial and real-estate data."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run inside tasks travel with the plan, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
