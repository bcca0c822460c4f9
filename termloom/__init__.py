"""termloom: a PySpark engine for course documents, records, calendars and the corpus around them."""

import sys

from pyspark import cloudpickle

# Workers get the package's functions with the plan, so that it needn't be installed on executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
