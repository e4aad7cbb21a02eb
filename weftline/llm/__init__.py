"""Operators for training data. Nothing else in the library imports this package."""

from pyspark import cloudpickle

import weftline

# functions go to the executors with their code, so executors need not have the package installed
cloudpickle.register_pickle_by_value(weftline)
