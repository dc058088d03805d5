"""File sources."""

from saleslake.sources.files import read_source
from saleslake.sources.xlsx import read_xlsx

__all__ = ["read_source", "read_xlsx"]
