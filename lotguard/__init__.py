"""lotguard: a batch-keyed data-quality engine for inspection lots on PySpark.

Every operator takes and returns DataFrames; nothing collects row data to the
driver. See README.md for the module map.
"""

from lotguard.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
