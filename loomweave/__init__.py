"""loomweave: threaded-discussion analytics as Spark DataFrame/SQL jobs."""

import sys as _sys

__version__ = "0.1.0"

# Python workers may not have this package on their path (the driver adds it at
# run time), so the few pandas UDF helpers are shipped by value, not by name.
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle without the hook
    pass
