"""gridloom: preparation of gridded geophysical fields with Spark DataFrames.

A field is a long-form DataFrame with one row per cell.  Index columns (``y``, ``x`` and, where they apply,
``field_id``, ``t``, ``z``, ``pl``) address the cell, ``value`` holds the number.  NULL means masked, NaN means "outside
the source's domain", a missing row means that the cell does not exist.
"""

import sys

from pyspark import cloudpickle

# Helpers that run inside Python tasks travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
