"""Operators of a pipeline for language-model training data, on DataFrames of documents.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# The functions that run inside tasks travel with the job, so executors need no copy of the package.
register_pickle_by_value(sys.modules[__name__])
