"""llm: operators for training-data pipelines (search, near-duplicates, filters, models, packing, mixing).

Nothing outside this subpackage, ``corpus_pipeline.py`` and the guarded hook in
``__spark_entry__.py`` imports it.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
