"""tillsense: a Spark-native retail demand and pricing engine.

Every public function takes and returns ``pyspark.sql.DataFrame`` objects
and builds a lazy plan; nothing is collected to the driver except model
fitting (``pyspark.ml``) and explicit gates.
"""

from tillsense.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
