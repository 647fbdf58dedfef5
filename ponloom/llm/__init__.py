"""Operators for preparing training text at scale.

The functions of this package are sent to executors with the tasks that use them, so that nothing has to be
installed there beyond the libraries named in the README.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
