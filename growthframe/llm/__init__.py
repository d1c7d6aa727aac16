"""Training-data operators over text corpora; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# The functions of this subpackage travel with the jobs that use them: executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
