"""salesmart: a Spark-native sales warehouse.

Raw order sources are cleaned into staging tables, reshaped into a star
schema (customer, product and date dimensions around an order-line fact),
pre-aggregated into marts and queried for business answers and chart-ready
tables. Every transform is a lazy ``DataFrame -> DataFrame`` function built
from Spark expressions; actions happen only in the pipeline job, the check
jobs and the caller.
"""

from salesmart.params import Params

__all__ = ["Params"]
