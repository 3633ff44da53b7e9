"""The registered queries over the test tables, each with its check SQL where SQL can state the result."""


def load() -> None:
    """Import the modules that register queries."""
    from registry import demos, functions, generation, marts, operators, quality, tables  # noqa: F401
