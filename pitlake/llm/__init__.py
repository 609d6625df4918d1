"""Operators that prepare documents, pages and conversations for training language models.

Nothing else in the library imports this subpackage. Its functions travel to the executors by value,
so that the executors need Python, numpy and pyarrow, but not the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
