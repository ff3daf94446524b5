"""What the library raises by itself."""


class ModelError(ValueError):
    """A declaration that cannot hold."""


class UnsupportedQuery(NotImplementedError):
    """A query form outside the document query surface."""


class EmptyResult(LookupError):
    """A scalar that needs rows met none."""


class AmbiguousResult(LookupError):
    """``single`` met more than one row."""
