"""Errors raised on the driver.  Malformed HTML is never an error.

Edits that may not apply (an attribute on a text node, removing the document node) are only known
row by row; they fail the Spark job, or are skipped and listed (see operators.mutate).
"""


class SelectorParseError(ValueError):
    """The selector text is not valid."""


class UnsupportedSelector(ValueError):
    """The selector is valid CSS but this library cannot evaluate it; never answered with an empty result."""
