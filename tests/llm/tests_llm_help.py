"""Brute-force versions that more than one test module uses."""

import hashlib

from test_text_operators import LOW, brute_hits

__all__ = ["brute_hits", "brute_lines"]


def brute_lines(docs):
    """(id, what is left, its digest) after lines in three or more documents are dropped."""
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOW)
    holders = {}
    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t in docs:
        kept = "\n".join(x for x in (t or "").split("\n") if len(holders.get(key(x), ())) < 3 or max(holders[key(x)]) == i)
        out.append((i, kept, hashlib.sha256(kept.encode()).hexdigest()))
    return out
