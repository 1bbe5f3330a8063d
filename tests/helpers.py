"""What several test modules share."""


def rows(df, *columns):
    """Sorted tuples of a frame's rows."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
