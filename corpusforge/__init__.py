"""corpusforge: corpus preparation and training-data table work on Spark.

Every public function takes DataFrames plus plain parameters and returns
DataFrames; nothing here owns a session.
"""

import sys

from pyspark import cloudpickle as _cloudpickle

# Python stages (pandas UDFs, mapInPandas) reference helpers of this package;
# shipping them by value means executors need no installed copy of it.
_cloudpickle.register_pickle_by_value(sys.modules[__name__])

from corpusforge.session import build_session, cut_lineage, ensure_checkpoint_dir  # noqa: E402

__all__ = ["build_session", "cut_lineage", "ensure_checkpoint_dir"]
