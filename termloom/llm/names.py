"""Names for columns that an operator adds to those of its input."""

from __future__ import annotations


def free_names(taken: list[str], *wanted: str) -> list[str]:
    """The wanted names, each with underscores in front until no column of the input has it, whatever its case."""
    low = {t.lower() for t in taken}
    out = []
    for name in wanted:
        while name.lower() in low:
            name = f"_{name}"
        low.add(name.lower())
        out.append(name)
    return out
