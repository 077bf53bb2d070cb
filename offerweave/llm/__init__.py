"""Operators for preparing language-model training data."""

from pyspark import cloudpickle

import offerweave

# Functions of this package travel to the executors by value: nothing has to be installed there.
cloudpickle.register_pickle_by_value(offerweave)
