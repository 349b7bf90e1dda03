"""agora: a Spark-native warehouse for social-media discourse.

Every public function takes DataFrames (or Columns) and returns DataFrames
(or Columns); nothing runs until the caller writes or reads the result.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Python helpers travel with the tasks that use them, so executors need no
# installed copy of this package.
register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
