"""Errors raised by the library."""

from __future__ import annotations


class StrataError(Exception):
    """Base of every error raised here."""


class InvalidName(StrataError):
    """A layer, project, dataset, topic or partition name that is not allowed."""


class SelfOverwrite(StrataError):
    """A job would delete the files it is about to read."""


class SchemaMismatch(StrataError):
    """A frame does not have the columns or types its contract asks for."""


class ReconciliationFailed(StrataError):
    """Row counts differ between layers, or the gold output is empty."""


class ModelNotFound(StrataError):
    """No SQL model of that name exists for the project."""

    exit_code = 2


class LateRows(StrataError):
    """A stream left out events that came behind its watermark."""


class ChangedSource(StrataError):
    """A file that was ingested before has other content now."""


class NoSharedFolder(StrataError):
    """A cluster session names no folder that all its machines see."""


class ForeignRows(StrataError):
    """Rows of other days came with those of the day to land."""
