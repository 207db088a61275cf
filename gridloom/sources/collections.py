"""Gene-set collections and classifier models by keyword, over local folders only: nothing is downloaded."""

from __future__ import annotations

import re
from pathlib import Path

DEFAULT = ("HALLMARK", "REACTOME")
# How files of a collection are named, `<group>.<part>...v<release>.symbols.gmt`.
_FILE = re.compile(r"^(?P<name>[a-z0-9]+(?:\.[a-z0-9_]+)*?)\.v(?P<release>[0-9][0-9A-Za-z.]*?)\.symbols\.gmt$", re.IGNORECASE)


def index(folder: str) -> tuple[str | None, dict[str, str]]:
    """(release, path by keyword) of a folder's collections, of the latest release. A file answers to its full name
    (``C2_CP_REACTOME``), to its last part (``REACTOME``) where one file only has it, and ``h.all`` to HALLMARK."""
    found: dict[str, list[tuple[str, str]]] = {}
    for path in sorted(Path(folder).glob("*.gmt")):
        if match := _FILE.match(path.name):
            found.setdefault(match["release"], []).append((match["name"], str(path)))
    if not found:
        return None, {}
    release = max(found, key=lambda r: ([int(x) for x in re.findall(r"\d+", r)], r))
    names: dict[str, str] = {}
    short: dict[str, list[str]] = {}
    for name, path in found[release]:
        parts = name.upper().split(".")
        names["_".join(parts)] = path
        short.setdefault("HALLMARK" if parts[0] == "H" else parts[-1], []).append(path)
    names |= {k: paths[0] for k, paths in short.items() if len(paths) == 1 and k not in names}
    return release, names


def keywords(folder: str) -> list[str]:
    return sorted(index(folder)[1])


def resolve(spec: str | list[str] | None, folder: str) -> tuple[list[str], list[str], str | None]:
    """(paths without repeats, what they were asked by, release if a keyword was used) of keywords and ``.gmt`` paths, as a
    list or a text parted by commas; none asks for the default. Unknown ones are skipped unless all are."""
    items = list(DEFAULT) if spec is None else [x.strip() for x in (spec.split(",") if isinstance(spec, str) else map(str, spec)) if x.strip()]
    if not items:
        raise ValueError("no gene sets are asked for")
    release, names = index(folder)
    paths, used, by_keyword = [], [], False
    for item in items:
        if item.lower().endswith(".gmt"):
            path = str(Path(item).expanduser().resolve())
            if not Path(path).is_file():
                continue
            used.append(path)
        elif item.upper() in names:
            path, by_keyword = names[item.upper()], True
            used.append(item.upper())
        else:
            continue
        if path not in paths:
            paths.append(path)
    if not paths:
        raise ValueError(f"none of the gene sets {items} is there; known: {sorted(names)[:10]}")
    return paths, used, release if by_keyword else None


def models(folder: str, suffixes: tuple[str, ...] = (".pkl",)) -> dict[str, str]:
    """Classifier models of a folder by name; reading them is left to the program that made them."""
    return {p.stem: str(p) for p in sorted(Path(folder).iterdir()) if p.suffix in suffixes}
