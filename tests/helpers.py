"""What several test modules of the main library use."""

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def rows(df, *cols):
    """Sorted list of tuples, for order-insensitive comparisons."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
