"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage; its queries are in
``statlens.llm.queries`` and are added by ``__spark_entry__.py`` only when the
subpackage is there.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the tasks by value, so executors need
# numpy, pandas and xxhash but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
