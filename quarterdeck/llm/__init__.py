"""Operators for training text. Nothing else in the library imports this subpackage."""


def load():
    """(queries, sql) of the subpackage."""
    from quarterdeck.llm import queries, registry

    assert queries
    return dict(registry.QUERIES), dict(registry.ORACLES)
