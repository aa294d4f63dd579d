"""Rows and times for tests, in a module whose name no other folder of tests has."""

import datetime as dt

AS_OF = dt.datetime(2024, 1, 31, 12, 0)


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))


def one(df, **key):
    """The single row with the given key, as a dict."""
    found = df
    for k, v in key.items():
        found = found.filter(f"{k} = '{v}'")
    got = found.collect()
    assert len(got) == 1, got
    return got[0].asDict(recursive=True)


def ms(year, month, day, hour=0, minute=0, second=0):
    return int(dt.datetime(year, month, day, hour, minute, second, tzinfo=dt.timezone.utc).timestamp() * 1000)
