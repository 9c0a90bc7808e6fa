"""Expected failures of the readers and of publishing."""

from __future__ import annotations


class IngestionError(Exception):
    """The input was refused; the message lists what was found, file by file."""


class InputError(IngestionError):
    """Path, kind, size or number of input files."""


class ArchiveError(IngestionError):
    """An unsafe, oversized, unexpected or damaged archive."""


class DelimitedError(IngestionError):
    """Encoding, delimiter, header or records of a delimited file."""


class ConflictError(Exception):
    """Another version was committed since the one that a writer builds on."""
