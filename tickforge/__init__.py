"""tickforge: a PySpark-native trade-tape lakehouse, feature, drift and forecast library.

Every operator is a plain function ``DataFrame -> DataFrame`` (or a small report
DataFrame); the Spark session is whatever the caller passes in.
"""

__version__ = "0.1.0"
