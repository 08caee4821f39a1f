"""Queries over the given tables for every operator, with oracle SQL where SQL can say the same."""

import sys

from pyspark import cloudpickle

from workload import classes, files, grids, jobs, regions, regridding, series, surfaces  # noqa: F401
from workload.registry import QUERIES  # noqa: F401

cloudpickle.register_pickle_by_value(sys.modules[__name__])
