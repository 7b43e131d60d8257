"""Operators on text corpora: dedup, scans, classifiers, mixing, tokenising. Nothing else imports this package."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code, so that these need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
