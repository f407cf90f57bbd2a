"""Spark jobs that build, audit and query releases of video-provenance aggregates."""

__version__ = "0.1.0"
