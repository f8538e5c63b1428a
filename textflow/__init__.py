"""textflow: train, evaluate and serve text classifiers on Spark DataFrames.

Sub-packages:

* ``sources``    -- batch and streaming readers (CSV corpus, file/Kafka streams,
                    prediction read-back, saved models)
* ``functions``  -- column-level helpers (tokenising, stop words, JSON, flags,
                    keyed hashing)
* ``operators``  -- DataFrame operators (prep, profile, splits, features,
                    evaluation, exact AUC, training, registry, monitoring)
* ``streaming``  -- micro-batch scoring with model hot-swap and idempotent sinks
* ``plans``      -- the named query plans exposed through ``__spark_entry__``
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Python workers may run where this package is not importable (a job started
# from another folder, executors without the source tree): functions and classes
# of the package travel with the task by value instead of by module name.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
