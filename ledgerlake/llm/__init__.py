"""Training-data operators: toxicity, deduplication, packing, URL rules, LM scores, PII, fingerprints, shards, decontamination,
BPE, centroid clustering, spelling variants.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
