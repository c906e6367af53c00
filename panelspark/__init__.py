"""Tabular ingestion, keyed tables and rolling correlations on Spark."""

import sys

from pyspark import cloudpickle

# Arrow functions and data sources travel with the job, so executors need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
