"""Small helpers over frames, for tests."""


def values(df, *order):
    """Rows as tuples, sorted by the given columns or by all."""
    ordered = df.orderBy(*order) if order else df.orderBy(*df.columns)
    return [tuple(r) for r in ordered.collect()]
