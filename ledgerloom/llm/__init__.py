"""Operations on corpora for training language models.

Nothing else in the library imports this package. ``catalog.QUERIES`` lists its registered queries.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to Python workers with the task, so executors do not need
# the library installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
