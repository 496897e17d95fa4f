"""Errors raised on the driver; row errors are columns or ``raise_error`` expressions."""


class DataParseError(ValueError):
    """A setting or a document cannot be understood."""


class DataPublishError(RuntimeError):
    """A result cannot be written."""
