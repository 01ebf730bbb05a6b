"""Operators of a training-data pipeline: exact search, classifiers, dedup,
mixing, WARC archives, link-graph filters, decontamination and PII.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its
queries when it is present.  Functions that run in tasks travel by value, so
executors need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
