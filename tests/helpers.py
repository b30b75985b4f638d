"""What test modules have in common."""

SF = "/root/testdata/sf0.001"


def rows(df, *order):
    """Rows as sorted tuples."""
    return sorted([tuple(r) for r in df.collect()], key=lambda r: tuple((x is not None, str(x)) for x in r))
