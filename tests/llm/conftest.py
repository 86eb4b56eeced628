import sys

from pyspark import cloudpickle

import corpus_pipeline

# Functions run in tasks travel with the job, as the package's own do.
cloudpickle.register_pickle_by_value(sys.modules[corpus_pipeline.__name__])
