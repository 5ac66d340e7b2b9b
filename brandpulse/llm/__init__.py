"""llm: operators for preparing training text at scale (deduplication, quality, scoring, mixing,
tokenising, exact search). Nothing else in the library imports this package.

Python functions of this package that run inside tasks are shipped by value, so executors need no
copy of the package on their own path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
