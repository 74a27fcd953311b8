"""Operators for the preparation of large text corpora, and their registered queries."""

import sys

from pyspark import cloudpickle

# tasks get this subpackage's functions with the job, so executors need no copy of it on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
