"""Failure classes, so callers can tell causes apart without reading messages."""


class HustingsError(Exception):
    """Base class of every error raised by this package."""


class ConfigurationError(HustingsError):
    """A setting is missing or wrong."""


class UnknownSourceError(HustingsError):
    """A dataset id that the registry does not hold."""


class AuthenticationError(HustingsError):
    """A landed response says the key was missing or refused."""


class DatasetUnavailableError(HustingsError):
    """The table or response holds no data."""


class SchemaChangeError(HustingsError):
    """A landed file no longer has the columns its reader expects."""


class ParserError(HustingsError):
    """A landed file cannot be read as the expected format."""


class NormalizationError(HustingsError):
    """A frame cannot be mapped onto its canonical table."""


class ValidationError(HustingsError):
    """Quality rules of severity ``error`` failed."""


class PointInTimeError(HustingsError):
    """A point-in-time cut cannot be applied, or has been violated."""
