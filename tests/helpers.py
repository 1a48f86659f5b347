"""Shared by the test modules, imported by full name (a conftest of a subfolder can't hide it)."""

SF_SMALL = "/root/testdata/sf0.001"


def rows(df, *cols):
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
