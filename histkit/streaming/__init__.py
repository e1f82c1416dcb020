"""Incremental loads driven by a stream of landed files."""

from .available import load_available

__all__ = ["load_available"]
