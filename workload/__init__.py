"""Registered queries and the SQL they are checked against."""

import sys

from pyspark import cloudpickle

# Models that a query passes in travel with the job, as the package's own helpers do.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
