"""tallyframe: reconcile many noisy descriptions of the same record layouts on Spark.

``functions``  column expressions (no shuffle)
``operators``  DataFrame -> DataFrame operators
``sources``    readers and writers
``streaming``  Structured Streaming forms of the incremental operators
``plans``      the operators wired together and bound to tables
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
