"""tapflow: fare-card tap analytics on Spark.

Tap-in / tap-out events are validated, de-duplicated, paired into trips per
card, counted per vehicle, flagged when crowded and routed to a dead-letter
table when rejected.  Every operator is a ``DataFrame -> DataFrame`` function
that works on batch tables and (unless its name ends in ``_stream``) on
streaming DataFrames alike.
"""

__version__ = "0.1.0"
