"""doselake: vaccination-coverage analytics as lazy PySpark DataFrames.

Layers: ``sources`` (CSV drops, tables, seeds) -> ``plans.silver`` ->
``plans.dimensions`` / ``plans.facts`` -> ``plans.measures``, with ``operators``
holding the reusable relational steps and ``functions`` the column rules.
"""

import sys

from pyspark import cloudpickle

# The few functions that run in Python workers travel with the task, so executors
# need Spark's own Python dependencies but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
