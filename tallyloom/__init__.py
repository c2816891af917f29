"""tallyloom: onboard raw tables and documents on Spark, then ask questions of them.

Every public function takes DataFrames (or paths) and returns a lazy DataFrame;
the work itself always runs as Spark stages.
"""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel with their code, so workers need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
