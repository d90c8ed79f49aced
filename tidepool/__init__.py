"""tidepool: the first layers of a real-time e-commerce warehouse on Spark.

Raw app logs and database change records go in; dirty records are set aside,
the first-visit flag is repaired per device, logs are split into start, page and
display datasets, change envelopes are normalised, routed by a rule table and
upserted into dimension tables, and each device's first visit of the day is
reported. Every transform is a DataFrame -> DataFrame function; the stateful
ones also have a Structured Streaming form in ``tidepool.streaming``.
"""

from tidepool.session import get_session, checkpoint_root

__all__ = ["get_session", "checkpoint_root"]
