"""Training-data operators; nothing else in the library imports this package.

Functions of this package travel to executors by value, so the executors need the public libraries
only, not the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
