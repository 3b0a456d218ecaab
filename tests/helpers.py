"""What several test modules share."""


def rows(df, *columns):
    """Sorted tuples of a frame."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda r: [(v is None, str(v)) for v in r])
