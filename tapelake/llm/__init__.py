"""Operators for training-data pipelines: archives, near duplicates, filters, formatting and mixing.

Nothing else in the library imports this package. ``queries.py`` registers one query per operator.
"""

import sys

from pyspark import cloudpickle

# Tasks get the functions of this package with the job, so executors need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
