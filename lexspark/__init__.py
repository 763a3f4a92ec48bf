"""PySpark-native analytics for structured legal text.

Sub-packages: ``functions`` (column expressions and rule tables), ``operators``
(DataFrame to DataFrame), ``sources`` (readers, writers, adapters), ``plans``
(query catalogue and end-to-end flows), ``streaming`` (Structured Streaming).
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Executors need no installed copy: functions of this package travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
