"""Table and stream operators for Spark, each a ``DataFrame -> DataFrame`` function."""

from sparkloom.session import checkpoint_root, get_session

__all__ = ["checkpoint_root", "get_session"]
