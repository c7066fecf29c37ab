"""Operators of a training-data pipeline: extraction, deduplication, filters, packing, archives.

Nothing else in the library imports this package. Its functions are pickled by value, so that
tasks run on executors that have only the Python packages and not this library.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
