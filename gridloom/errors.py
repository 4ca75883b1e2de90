"""Exceptions raised by the library."""


class DataLoadError(Exception):
    """A table could not be read; the message is fit to show to a user."""
