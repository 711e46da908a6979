"""Errors a job can raise. All derive from ``LakeError``."""


class LakeError(Exception):
    """Base class."""


class UnsupportedFormat(LakeError, ValueError):
    """The file type of a load is not one of the known types."""


class MissingPackage(LakeError):
    """A data source needs a package that is not on Spark's class path."""


class BadInput(LakeError, ValueError):
    """The input cannot be a valid load: one column, colliding names, no rows."""


class QualityError(LakeError, ValueError):
    """Required columns are absent or hold nulls."""


class AlreadyLanded(LakeError):
    """The dated stage folder exists; a landing never overwrites."""


class JobFailed(LakeError):
    """A job stopped. Its metrics row has been written."""
