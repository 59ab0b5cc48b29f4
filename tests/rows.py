"""Rows in a fixed order, for comparisons."""


def rows_of(frame, *columns):
    """Rows as a sorted list of tuples; nulls first."""
    picked = frame.select(*columns) if columns else frame
    return sorted(
        (tuple(r) for r in picked.collect()),
        key=lambda t: tuple((x is not None, str(x)) for x in t),
    )
