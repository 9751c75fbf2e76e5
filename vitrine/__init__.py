"""vitrine: a multimodal product-catalogue pipeline on Spark."""

import sys

from pyspark import cloudpickle

# Functions handed to tasks travel with the job, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
