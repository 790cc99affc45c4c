"""Files that tasks read and make: by path or URI, without a part of one ever standing under its final name."""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Callable

import pyarrow.fs as pafs

BLOCK = 1 << 20


def opened(place: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path) of an absolute path or a URI; that of a local file is taken as Hadoop takes it, with no escapes in it."""
    place = re.sub(r"^file:/(//(?=[^/]|$)|(?!/))", "/", place)
    return pafs.FileSystem.from_uri(place) if "://" in place else (pafs.LocalFileSystem(), os.path.abspath(place))


def join(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"


def make_folder(place: str) -> None:
    fs, path = opened(place)
    fs.create_dir(path, recursive=True)


def listing(path: str) -> pafs.FileSelector:
    """What a file system needs to list a folder; one that is not there is empty."""
    return pafs.FileSelector(path, allow_not_found=True)


def exists(place: str) -> bool:
    fs, path = opened(place)
    return fs.get_file_info(path).type != pafs.FileType.NotFound


def hash_of(place: str) -> str | None:
    """SHA-256 of a file, a block at a time; None if there is none."""
    fs, path = opened(place)
    digest = hashlib.sha256()
    try:
        with fs.open_input_stream(path) as f:
            while block := f.read(BLOCK):
                digest.update(block)
    except FileNotFoundError:
        return None
    return digest.hexdigest()


def copied_to(source: str, out: object) -> str:
    """Write a file's bytes to ``out``; their SHA-256."""
    fs, path = opened(source)
    digest = hashlib.sha256()
    with fs.open_input_stream(path) as f:
        while block := f.read(BLOCK):
            digest.update(block)
            out.write(block)
    return digest.hexdigest()


def make(target: str, staging: str, sha256: str, write: Callable[[object], None]) -> None:
    """Make ``target`` with the given hash, which must not exist with another: written under a name of its own in ``staging``, read again, and put in place whole.

    A task that is run again finds the file as it should be, and is done. ValueError where the bytes differ, FileExistsError where another file has the name.
    """
    fs, path = opened(target)
    if (there := hash_of(target)) is not None:
        if there == sha256:
            return
        raise FileExistsError("another file has this name")
    folder = opened(staging)[1]
    fs.create_dir(folder, recursive=True)
    name = uuid.uuid4().hex
    temporary = join(folder, name)
    try:
        with fs.open_output_stream(temporary) as out:
            write(out)
        if hash_of(join(staging, name)) != sha256:
            raise ValueError("what was written differs from the plan")
        fs.create_dir(path.rpartition("/")[0], recursive=True)
        if isinstance(fs, pafs.LocalFileSystem):
            try:
                os.link(temporary, path)  # fails where another attempt was faster
            except FileExistsError:
                if hash_of(target) != sha256:
                    raise
        else:
            fs.move(temporary, path)
    finally:
        if fs.get_file_info(temporary).type != pafs.FileType.NotFound:
            fs.delete_file(temporary)


def remove(place: str) -> None:
    fs, path = opened(place)
    fs.delete_file(path)


def remove_folder(place: str) -> None:
    fs, path = opened(place)
    if fs.get_file_info(path).type == pafs.FileType.Directory:
        fs.delete_dir(path)
