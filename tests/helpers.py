"""What several test modules use; ``conftest`` is a name that each test folder has for itself."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def rows(df):
    """Collect as a sorted list of tuples (columns sorted by name)."""
    cols = sorted(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))
