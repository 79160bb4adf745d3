"""Errors raised by table jobs before any data is touched."""


class TableJobError(Exception):
    """Base class for job errors."""


class SchemaMismatchError(TableJobError):
    """A positional insert would pair columns that do not belong together."""

    def __init__(self, message: str, diff: list[str]):
        super().__init__(message + ("\n  " + "\n  ".join(diff) if diff else ""))
        self.diff = diff


class SelfOverwriteError(TableJobError):
    """The write target is also a source of the data being written."""


class CapabilityError(TableJobError):
    """A format or connector is not available in this session."""


class EncodingError(TableJobError):
    """Values cannot be represented in the target text encoding."""
