"""Market-signal analytics on Spark: candles, indicators, alert rules and delivery."""

import sys

from pyspark import cloudpickle

# The few Python functions that run in tasks travel with the job, so workers need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
