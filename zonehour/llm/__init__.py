"""Operators for large training-data pipelines. Nothing outside this
subpackage imports it.

Python functions of this subpackage that run inside Spark tasks are shipped
with the task (pickled by value), so executors need numpy, pyarrow and the
tokenizer library but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
