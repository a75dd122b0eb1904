"""barlake: a PySpark data product for market price bars and tick trades."""

import sys

from pyspark import cloudpickle

from barlake.session import build_session, scratch_dir

# Functions sent to executors travel by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "scratch_dir"]
