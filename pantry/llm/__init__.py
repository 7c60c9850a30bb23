"""Training-data operators: sharding, toxicity, chat formatting, license scans,
near duplicates, repeated passages, decontamination, WARC, packing, quality.

Nothing outside this folder imports it.  Functions that run on executors are
pickled by value, so that workers need not have the package on their path.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
