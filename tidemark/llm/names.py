"""Names of result columns beside whatever columns a table already has."""

from __future__ import annotations

from collections.abc import Iterable


def fresh(names: Iterable[str], taken: Iterable[str]) -> list[str]:
    """The names, each with as many underscores behind it as it takes to differ from ``taken`` and from each other."""
    used, found = {name.lower() for name in taken}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        found.append(name)
    return found
