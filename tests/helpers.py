import datetime as dt


def day(text):
    return dt.date.fromisoformat(text) if text else None


def ts(text):
    return dt.datetime.fromisoformat(text) if text else None


def rows(df, *order):
    """Rows as dicts, sorted by the given columns."""
    found = [r.asDict() for r in df.collect()]
    return sorted(found, key=lambda r: _key([r[c] for c in order])) if order else found


def _key(values):
    return tuple((v is not None, 0 if v is None else str(v) if isinstance(v, (list, bool)) else v) for v in values)


def bag(df, *columns):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=_key)
