"""Column builders. Each takes and returns ``Column`` and stays inside generated code unless its module says otherwise."""

from . import bitwise, dates, json, math, sets, spatial, vector

__all__ = ["bitwise", "dates", "json", "math", "sets", "spatial", "vector"]
