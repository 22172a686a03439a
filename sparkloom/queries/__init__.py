"""The library's queries over the sample tables, with SQL that gives the same rows."""

from . import changes, core, documents, extensions, scalars, windows
from .base import REGISTRY

__all__ = ["REGISTRY", "changes", "core", "documents", "extensions", "scalars", "windows"]
