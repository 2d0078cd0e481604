"""Operators for preparing training corpora for language models: archives,
secret scans, toxicity, sharding, quality, language, mixing, near-dedup,
decontamination and fingerprints. Nothing outside this subpackage imports it."""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# task functions travel with the job, so executors need no copy of the package
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
