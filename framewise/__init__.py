"""framewise: frame-sequence analytics on Spark.

Every operator is a plain function that takes and returns a DataFrame; nothing
in the library collects rows to the driver.  See README.md for the module map.
"""

from framewise.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
