"""Reading result frames in tests."""


def rows(df, *columns):
    """Result rows as sorted tuples, NULLs first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is not None, v) for v in t])


def by(df, *keys):
    """Result rows as dicts, indexed by key."""
    found = {}
    for r in df.collect():
        key = tuple(r[k] for k in keys)
        assert key not in found, f"key {key} occurs twice"
        found[key[0] if len(keys) == 1 else key] = r.asDict()
    return found
