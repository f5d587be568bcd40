"""shelfline: retail supply-chain analytics as PySpark DataFrame functions.

Every operator takes DataFrames (and an explicit ``as_of`` date where the
answer depends on "today") and returns a DataFrame.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few Python functions that run in executors travel with the job by value,
# so the package need not be installed on the workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
