"""Frames as plain values, for comparisons."""


def rows(frame):
    """Rows as sorted plain tuples."""
    return sorted((tuple(row) for row in frame.collect()), key=repr)
