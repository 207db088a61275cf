"""Dataset folders as one compressed tar file, and back. Works on local paths; members never leave the target folder."""

from __future__ import annotations

import os
import tarfile
from pathlib import Path, PurePosixPath

SUFFIX = ".tar.zst"


def _codec():
    try:
        import zstandard
    except ImportError as missing:
        raise RuntimeError("archives need the zstandard package") from missing
    return zstandard


def check_members(names: list[str]) -> None:
    """Refuses absolute members and any that climbs out of the folder."""
    for name in names:
        if name.startswith(("/", "\\")) or ".." in PurePosixPath(name.replace("\\", "/")).parts:
            raise ValueError(f"a member of the archive lies outside of it: {name!r}")


def pack(folder: str, archive: str, level: int = 10) -> str:
    """Writes a folder as ``archive``; its members are relative to the folder's parent."""
    source = Path(folder)
    if not source.is_dir():
        raise FileNotFoundError(folder)
    part = f"{archive}.part"
    with open(part, "wb") as raw, _codec().ZstdCompressor(level=level).stream_writer(raw) as packed, tarfile.open(fileobj=packed, mode="w|") as tar:
        tar.add(source, arcname=source.name)
    os.replace(part, archive)  # an archive is either whole or not there
    return archive


def members(archive: str) -> list[str]:
    with open(archive, "rb") as raw, _codec().ZstdDecompressor().stream_reader(raw) as plain, tarfile.open(fileobj=plain, mode="r|") as tar:
        return [m.name for m in tar]


def unpack(archive: str, target: str) -> str:
    """Extracts an archive of files and folders below ``target`` and returns the folder it holds."""
    names = members(archive)
    check_members(names)
    with open(archive, "rb") as raw, _codec().ZstdDecompressor().stream_reader(raw) as plain, tarfile.open(fileobj=plain, mode="r|") as tar:
        for member in tar:
            if not (member.isfile() or member.isdir()):
                raise ValueError(f"a member of the archive is neither a file nor a folder: {member.name!r}")
            tar.extract(member, target, filter="data")
    roots = {PurePosixPath(n).parts[0] for n in names if n}
    return str(Path(target) / roots.pop()) if len(roots) == 1 else target
