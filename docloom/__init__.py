"""docloom: document intelligence expressed as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# Functions run inside tasks travel with the job, so executors need no copy of
# the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
