"""Road-checkpoint analytics on Spark: batch and streaming operators over
vehicle-passage, violation and police-action records."""

import sys as _sys

# Python that runs inside Spark tasks (the replay fold, the streaming state
# processors) is shipped by value, so executors need no installed copy of
# this package (as with --py-files, but with nothing to stage).
try:
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle without by-value support
    pass
