"""tidewater: Spark-native medallion operators for product-event analytics.

Every operator is a DataFrame -> DataFrame function with plain parameters; no
operator collects data, holds a global session or performs I/O. Sources and
sinks live in their own sub-packages, composed plans in ``plans``.
"""

__version__ = "0.1.0"
