"""Moving ingested files out of the source directory."""

from __future__ import annotations

import hashlib
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame

from cartwright.sinks.hadoop import Files


def _csv_paths(scanned: DataFrame) -> list[str]:
    return [path for path in map(unquote, scanned.inputFiles()) if path.endswith(".csv")]


def file_set(scanned: DataFrame) -> str:
    """A name for the files behind ``scanned``: the same files give the same one."""
    digest = hashlib.sha256()
    for path in sorted(scanned.inputFiles()):
        digest.update(path.encode() + b"\n")
    return digest.hexdigest()[:16]


def check_archive(scanned: DataFrame, archive_dir: str) -> None:
    """Raise if archiving the files of ``scanned`` would meet a name that is taken.

    Called before anything is written, so that a load that can't be archived leaves no trace.
    """
    names = [path.rsplit("/", 1)[-1] for path in _csv_paths(scanned)]
    taken = set(Files(scanned.sparkSession).names(archive_dir))
    counts = Counter(names)
    clashes = sorted(name for name, n in counts.items() if n > 1 or name in taken)
    if clashes:
        raise FileExistsError(f"{archive_dir} can't take {', '.join(clashes[:5])}")


def archive_csv(scanned: DataFrame, archive_dir: str, threads: int = 16) -> int:
    """Move the ``*.csv`` files behind ``scanned`` flat into ``archive_dir``; return how many.

    Exactly the files of the scan are moved, so a file that arrived meanwhile stays for the next
    run. Files with other suffixes are read by the scan but stay where they are.
    """
    paths = _csv_paths(scanned)
    files = Files(scanned.sparkSession)
    files.make_dirs(archive_dir)
    root = archive_dir.rstrip("/")

    def move(path: str) -> None:
        files.move(path, f"{root}/{path.rsplit('/', 1)[-1]}")

    with ThreadPoolExecutor(max_workers=threads) as pool:
        for _ in pool.map(move, paths):
            pass
    return len(paths)
