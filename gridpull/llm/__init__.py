"""Training-data operators (toxicity, decontamination, dedup, tokens, ...).

Each module holds one operator with its own general interface; the thin
``opN_<name>`` queries over the driver tables are in ``queries``. Nothing
outside this subpackage imports it.

Functions that run inside Python workers are pickled by value, so executors
need numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
