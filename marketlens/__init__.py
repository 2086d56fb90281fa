"""marketlens: equity risk analytics as Spark DataFrame operators.

Layers (each one a plain ``DataFrame -> DataFrame`` function, built from
Spark's own expressions so Catalyst can prune, push down and fuse them):

* ``sources``    landing/raw readers and writers, tick codecs, table fixtures
* ``functions``  column expressions (rounding, guarded ratios, ids, severity)
* ``operators``  returns, risk marts, correlation, tick alerts, data quality
* ``plans``      the batch pipeline and the report pages built on the marts
* ``streaming``  Structured Streaming runners for the alert rules
"""

__all__ = ["session", "schemas"]
