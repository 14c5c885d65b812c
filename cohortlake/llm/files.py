"""Files of the operators' own formats, on any storage pyarrow or Spark's paths name."""

import contextlib
import uuid

import pyarrow.fs as pafs


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the place on it of a URI or an absolute path."""
    return pafs.FileSystem.from_uri(path)


@contextlib.contextmanager
def writing(folder: str, suffix: str):
    """A new file that appears below the folder, under a name of its own, once whole.

    A task that is run again writes another file; only files named in the rows of
    tasks that succeeded are ever read.
    """
    files, place = file_system(folder)
    files.create_dir(place, recursive=True)
    name = f"{uuid.uuid4().hex}{suffix}"
    with files.open_output_stream(f"{place}/.{name}.part") as out:
        yield name, out
    files.move(f"{place}/.{name}.part", f"{place}/{name}")


@contextlib.contextmanager
def reading(folder: str, name: str):
    files, place = file_system(folder)
    with files.open_input_file(f"{place}/{name}") as source:
        yield source
