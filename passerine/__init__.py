"""PySpark-native engine for customer event and profile data.

Every operator is a lazy ``DataFrame -> DataFrame`` function.  "Now" is always a
parameter, and nothing is collected to the driver inside an operator.
"""

from passerine.session import configure, get_session

__all__ = ["configure", "get_session"]
