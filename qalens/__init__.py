"""qalens: Spark-native analytics for question-and-answer site tables.

Every operator takes and returns a ``pyspark.sql.DataFrame`` and is built
from built-in Spark expressions, so Catalyst plans it and the cluster runs it.
"""

from qalens.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
