"""Connectors: each turns a source object's options into a DataFrame. Importing the package registers them all."""

from lakeplane.sources import catalogs, databases, files, graph, http  # noqa: F401
from lakeplane.sources.registry import CONNECTORS, connector, extract, resolve

__all__ = ["CONNECTORS", "connector", "extract", "resolve"]
