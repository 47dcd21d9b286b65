"""kintsugi: Spark-native table repair, validation and scoring.

Every public operator takes and returns lazy DataFrames.  Reports are small
DataFrames, never strings built on the driver.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Python code that runs inside tasks (mapInPandas scans) is shipped by value,
# so executors need no installed copy of this package.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from kintsugi.session import build_session, checkpoint_dir  # noqa: E402

__all__ = ["build_session", "checkpoint_dir"]
