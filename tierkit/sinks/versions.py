"""Replacing datasets in one step: write new version folders, then point to them.

A dataset at ``path`` holds ``_versions/<version>/`` folders and, in ``_pointer/``, one empty file per commit; its name
holds its number, the version, the time of the commit and the stamp that the version was made of.  The largest number is
the current one.  Creating that file is the commit: a write that fails leaves every reader at the previous version.

Several datasets that belong together (a table and its mirror) are one set: they share the version's name and the first
one's pointer, which the others name in a file ``_set``.  So one file commits all of them and the stamp at once, and
a crash between any two steps leaves a matching set.

The commit holds a lock file of its number, so of two replacements at once one raises.  After it, versions older
than the previous one are removed; the previous one stays for readers that started before.  A write that fails
removes its folders; those of a job that was killed are removed by ``vacuum`` (part of each replacement) once they are
older than ``ORPHAN_AGE_S``, being named by no pointer.  A new version may be computed from the current one: nothing
is overwritten.  Finding the current version lists a folder of two or three names; no job runs.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import SparkSession

from tierkit.control import age_s, create_new, delete_path, file_text, listed, path_exists, remove

ORPHAN_AGE_S = 24 * 3600  # a folder that no pointer names may be a running write until then
LOCK_AGE_S = 3600  # a lock is held for a few file-system calls; older ones are left by a crash


class Commit(NamedTuple):
    """What one pointer file says; ``stamp`` is '' where none was given."""
    name: str
    number: int
    version: str
    at_micros: int
    stamp: str


def _commits(spark: SparkSession, pointer: str) -> list[Commit]:
    """Commits of a pointer folder, the current one first."""
    out = []
    for st in listed(spark, pointer):
        name = st.getPath().getName()
        if name[:12].isdigit():
            number, version, *rest = name.split("-")
            out.append(Commit(name, int(number), version, int(rest[0]) if rest else 0, rest[1] if len(rest) > 1 else ""))
    return sorted(out, reverse=True)


def _pointer(spark: SparkSession, path: str) -> str:
    """The pointer folder that a dataset follows."""
    return file_text(spark, f"{path}/_set") or f"{path}/_pointer"


def _folder(path: str, version: str) -> str:
    return f"{path}/_versions/{version}"


def current_commit(spark: SparkSession, path: str) -> Commit | None:
    """The commit that a reader of ``path`` sees; ``None`` when it has no versions."""
    path = path.rstrip("/")
    own = f"{path}/_pointer"
    pointer = _pointer(spark, path)
    if pointer != own:  # before the set's first commit a member is what it was
        for c in _commits(spark, pointer):
            if path_exists(spark, _folder(path, c.version)):
                return c
    return next(iter(_commits(spark, own)), None)


def current_path(spark: SparkSession, path: str) -> str:
    """The folder to read: the current version, or ``path`` itself when it has no versions."""
    path = path.rstrip("/")
    commit = current_commit(spark, path)
    return _folder(path, commit.version) if commit else path


def _joined(spark: SparkSession, paths: list[str]) -> None:
    """Make the datasets one set, or see that they are."""
    first, *others = paths
    if _pointer(spark, first) != f"{first}/_pointer":
        raise ValueError(f"{first} is committed with {_pointer(spark, first)}")
    members = file_text(spark, f"{first}/_members")
    if members is not None and members.split("\n") != others:
        raise ValueError(f"{first} is committed together with {members}")
    for path in others:
        pointer = file_text(spark, f"{path}/_set")
        if pointer is None:
            create_new(spark, f"{path}/_set", f"{first}/_pointer")
        elif pointer != f"{first}/_pointer":
            raise ValueError(f"{path} is committed with {pointer}")
    if others and members is None:
        create_new(spark, f"{first}/_members", "\n".join(others))


def _locked(spark: SparkSession, pointer: str, number: int) -> str:
    lock = f"{pointer}/lock-{number:012d}"
    for _ in range(2):
        if create_new(spark, lock):
            return lock
        left = [st for st in listed(spark, pointer) if st.getPath().getName() == lock.rsplit("/", 1)[1] and age_s(st) > LOCK_AGE_S]
        if not left:
            break
        remove(spark, pointer, left)
    raise RuntimeError(f"{pointer} is being replaced by another job")


def replace_set(spark: SparkSession, members: dict[str, Callable[[str, dict], None]], stamp: str = "") -> dict[str, str]:
    """Let each member's ``write(folder, done)`` fill a new folder, then make them all current; returns the folders.

    ``members`` are written in order; ``done`` has the folders of those before.  Of two replacements at once the second
    to commit raises and leaves the first's versions.
    """
    paths = [p.rstrip("/") for p in members]
    _joined(spark, paths)
    pointer = f"{paths[0]}/_pointer"
    before = _commits(spark, pointer)
    number, version = (before[0].number if before else 0) + 1, uuid.uuid4().hex
    folders: dict[str, str] = {}
    try:
        for path, write in zip(paths, members.values(), strict=True):
            folders[path] = _folder(path, version)
            write(folders[path], folders)
        lock = _locked(spark, pointer, number)
        try:
            if _commits(spark, pointer) != before:
                raise RuntimeError(f"{paths[0]} was replaced meanwhile")
            create_new(spark, f"{pointer}/{number:012d}-{version}-{int(time.time() * 1_000_000)}-{stamp}")
        finally:
            delete_path(spark, lock)
    except BaseException:
        if not any(c.version == version for c in _commits(spark, pointer)):
            for folder in folders.values():
                delete_path(spark, folder)
        raise
    for old in before[1:]:
        for path in paths:
            delete_path(spark, _folder(path, old.version))
        delete_path(spark, f"{pointer}/{old.name}")
    for path in paths:
        vacuum(spark, path)
    return folders


def replace_dataset(spark: SparkSession, path: str, write: Callable[[str], None]) -> str:
    """Let ``write`` fill a new folder, then make it the current version; returns the folder.

    A dataset that is committed together with others raises: use ``replace_set`` for all of them.
    """
    path = path.rstrip("/")
    return replace_set(spark, {path: lambda folder, done: write(folder)})[path]


def vacuum(spark: SparkSession, path: str, min_age_s: float = ORPHAN_AGE_S) -> list[str]:
    """Remove version folders that no pointer names and that nothing was written to for ``min_age_s``; returns their names.

    The current version and the one before are named, so those of running readers stay.
    """
    path = path.rstrip("/")
    named = {c.version for p in {f"{path}/_pointer", _pointer(spark, path)} for c in _commits(spark, p)}
    orphans = []
    for st in listed(spark, f"{path}/_versions"):
        name = st.getPath().getName()
        inside = listed(spark, f"{path}/_versions/{name}") if name not in named and age_s(st) >= min_age_s else []
        if name not in named and all(age_s(s) >= min_age_s for s in (st, *inside)):
            orphans.append(st)
    remove(spark, path, orphans)
    return [st.getPath().getName() for st in orphans]
