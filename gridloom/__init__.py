"""Gridloom: tabular analytics and machine learning written as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run inside tasks travel with the job: workers need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
