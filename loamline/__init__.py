"""Soil-sensor and weather analytics as PySpark DataFrame operators."""

from loamline.config import Settings
from loamline.session import get_spark, scratch_path

__all__ = ["Settings", "get_spark", "scratch_path"]
