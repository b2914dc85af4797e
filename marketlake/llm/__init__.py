"""Training-data operators: packing, dedup, scans, search, chat, scoring, mixing, classifiers.

The functions that run inside tasks are shipped with the tasks (pickled by
value), so executors need not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
