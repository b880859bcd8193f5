"""tessera: cleaning, feature selection and stacked regression as Spark jobs."""

import sys

from pyspark import cloudpickle

# Python code that runs inside tasks (the Arrow-batched Gramian and scoring
# functions) is shipped by value, so executors need no installed copy of
# this package and no particular working directory.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
