"""lakeplane: a configuration-driven lakehouse engine made of DataFrame operators."""

__version__ = "0.1.0"
