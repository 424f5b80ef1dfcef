"""sluice: document ingestion, classification, routing and parsing as Spark DataFrame operators."""

from pyspark import cloudpickle as _cloudpickle

import sluice as _self

# Python functions of this package that run inside UDFs are shipped by value,
# so executors do not need the package installed or on their path.
_cloudpickle.register_pickle_by_value(_self)
