"""What several test modules share."""


def rows(df, *columns):
    """Rows as sorted tuples, for comparing small results."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
