"""affinity: purchase-affinity analytics as Spark DataFrame jobs.

Sub-packages
------------
sources    typed scans of the entity, transaction, label and request tables, and the sinks
functions  column-level building blocks (encodings, list text, pair expressions, keyed draws)
operators  relational operators: features, labels, pairs, recommendations, metrics, models
plans      end-to-end jobs, the query catalogue and the SQL oracles used for checking
"""

from affinity.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
