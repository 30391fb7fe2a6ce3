"""Training-data operators: packing, near-duplicate detection, mixing,
language identification, secret and licence scans, passage deduplication,
toxicity scoring and quality rules.

Nothing else in the library imports this subpackage. Functions that run in
Python workers are pickled by value, so executors need no installed copy.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
