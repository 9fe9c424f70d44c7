"""custseg: customer segmentation from invoice exports, as Spark DataFrame operators.

Layout:

- ``sources``   raw tab-separated exports, Parquet tables, model directories
- ``functions`` Column-expression helpers (text, hashing, statistics, string similarity)
- ``operators`` DataFrame -> DataFrame operators (cleaning, identity resolution, RFM,
                outlier removal, scaling, clustering, classification, evaluation, summaries)
- ``plans``     composed end-to-end jobs (clean, features, train, score)
- ``streaming`` stateless scoring of a streaming DataFrame
"""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# Functions of this package travel to the Python workers inside the tasks, so that executors
# need no copy of it on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
