"""Public-meeting records analytics on Spark: sources, text and caption
functions, term indexes, search, matching, keyed tables and streaming."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Executors need not have the package installed: its functions travel with the
# plans that use them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
