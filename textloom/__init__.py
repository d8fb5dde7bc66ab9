"""Corpus preparation for language-model training, written as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

# The few Python helpers travel to the executors by value, so nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
