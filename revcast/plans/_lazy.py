"""A mapping whose values are built on first access."""

from __future__ import annotations


class LazyMap(dict):
    """Mapping whose values are built on first access."""

    def __init__(self, builders):
        super().__init__()
        self._b = builders

    def __missing__(self, key):
        v = self._b[key]()
        self[key] = v
        return v

    def __contains__(self, key):
        return key in self._b

    def keys(self):
        return self._b.keys()
