"""kindling: reusable PySpark DataFrame operators for everyday data jobs.

Every operator takes DataFrames plus column names and returns a DataFrame, so
Spark plans, shuffles and spills the work. Nothing is collected to the driver
except small loop controls (iteration counters, bounded size checks).
"""

from kindling.session import checkpoint_dir, get_session, scratch_path

__all__ = ["get_session", "checkpoint_dir", "scratch_path"]
