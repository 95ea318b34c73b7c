"""Operations of a large-scale training-data pipeline over the ``documents`` table.

Functions that Spark runs in Python workers are sent to them by value, so the workers
need no copy of this package on their path.  Broadcast models are plain containers and
arrays for the same reason.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
