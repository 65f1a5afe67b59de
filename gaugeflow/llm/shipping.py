"""The package for the Python workers."""

from gaugeflow.sources.shipping import ship_package

__all__ = ["ship_package"]
