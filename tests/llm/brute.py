"""Plain versions of the contracts, a row at a time."""

import re

A_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower(text):
    return (text or "").translate(A_Z)


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def solid_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lower(text))


def rows(df):
    """(doc_id, text) of a table, nulls first, repeated rows kept."""
    got = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    return sorted(got, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))


def by_row(df, *columns):
    """The wanted columns of a result as a sorted list."""
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
