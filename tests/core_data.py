"""Data folders and helpers that the core tests import by name."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def rows(df, *cols):
    """Sorted list of tuples (NULLs first) for order-insensitive asserts."""
    cols = cols or df.columns
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is not None, x if x is not None else 0) for x in t))
