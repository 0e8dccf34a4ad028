"""panelscore: per-key histories to entity scores and their quality checks, on Spark DataFrames."""
from .session import checkpoint_dir, get_spark, work_path

__all__ = ["get_spark", "checkpoint_dir", "work_path"]
