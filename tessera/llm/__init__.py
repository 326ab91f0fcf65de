"""Operations of a training-data pipeline, one module per operator.

Nothing else in the library imports this subpackage; ``registry`` holds its
queries and their SQL, and the driver contract adds them when it is present.

Functions that run in tasks travel by value, so executors need the installed
libraries but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
