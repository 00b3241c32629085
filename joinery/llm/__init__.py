"""Operations of a training-data pipeline: deduplication, decontamination,
personal data, chat formatting, classifiers, packing, licence scans.

Nothing outside this subpackage imports it. Conventions shared by its operators:

* A null text has no words, lines or spans; a null or repeated id is legal and
  each input row gives one output row unless an operator says otherwise.
* Columns an operator adds replace input columns of the same name (compared
  without case). Names that start with two underscores are used inside.
* Tables that cut lineage are written under ``spark.checkpoint.dir``.
"""

import sys

from pyspark import cloudpickle

# functions that run in Python workers travel with their tasks, so that executors need
# no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
