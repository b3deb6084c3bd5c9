"""kiln: reusable Spark DataFrame operators for scans, relational work,
changes of Parquet tables and file streams.

Every operator is a function over ``DataFrame`` objects.  Nothing here builds a ``SparkSession`` or changes its
settings, apart from :func:`kiln.session.local_session`, which tests and the
bench use.
"""

from kiln.session import local_session, shared_dir, scratch_path

__all__ = ["local_session", "shared_dir", "scratch_path"]
