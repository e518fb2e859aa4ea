"""Operators for preparing training text: filters, deduplication, scans, audits and mixing."""

import sys

from pyspark import cloudpickle

# What tasks run is sent with them, so executors need no copy of this folder.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
