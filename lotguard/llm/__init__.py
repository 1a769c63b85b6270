"""Training-data operators; nothing else in the library imports this package.

Functions that run in Python workers are sent to them by value: workers need
not find the package on their own path, wherever the session was started.
"""

from pyspark import cloudpickle

import lotguard

cloudpickle.register_pickle_by_value(lotguard)
