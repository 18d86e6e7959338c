"""Training-data operators: scoring, filtering, deduplication, mixing,
tokenisation and chat formatting of document corpora.

One module per operator; ``queries`` registers one query per operator.
Nothing outside this package imports it.  Functions that run inside Spark
tasks are shipped by value, so executors need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
