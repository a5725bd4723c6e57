"""Millrace: exploratory and product analytics as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

from millrace.session import get_spark

# The few Python functions travel with the plan, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["get_spark"]
__version__ = "0.1.0"
