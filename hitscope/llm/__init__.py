"""Training-data pipeline operators (URL filters, line and document dedup,
HTML extraction, license scans, mixing, quality rules, token counts, WARC,
decontamination).  Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the Python workers by value, so
# executors need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
