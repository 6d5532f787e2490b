"""Hashtag-driven topic analytics over streams of short posts, on PySpark."""

from postlytics.settings import Settings

__all__ = ["Settings"]
