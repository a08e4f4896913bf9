"""frameweir: keyed streams of video-frame events on Spark."""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with the job, so the package need not
# be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
