"""Training-data operators on whole corpora: language, duplicates, quality, privacy, tokens.

The functions that run in tasks travel with the tasks, so executors need no copy
of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
