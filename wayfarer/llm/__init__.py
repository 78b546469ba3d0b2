"""Training-data operators (nothing outside this subpackage imports it).

Functions that run inside tasks are shipped by value, so executors need only
the third-party packages, not this repository on their Python path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
