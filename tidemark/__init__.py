"""Product-analytics jobs for a content feed and a messenger, written for Spark."""

from tidemark.params import Params

__all__ = ["Params"]
