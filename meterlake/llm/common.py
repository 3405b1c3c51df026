"""Shared pieces: words, scratch tables and files that workers can read."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.session import scratch_path

# the characters between words: space, tab, line feed, vertical tab, form feed, carriage return
BLANKS = "\t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text, none for NULL. Plain replacement and a one-character split stay
    off the regular-expression path."""
    plain = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        plain = F.replace(plain, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(plain, " "), "")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: lineage ends, and a lost executor
    costs a re-read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filesystem(uri: str):
    """The pyarrow file system of a URI or local path, and the path in it."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def write_file(uri: str, data: bytes) -> None:
    """A whole file under its final name: a partly written one is never seen."""
    system, path = filesystem(uri)
    parent = path.rsplit("/", 1)[0]
    system.create_dir(parent, recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}"
    with system.open_output_stream(draft, compression=None) as out:
        out.write(data)
    system.move(draft, path)


def mapped(uri: str) -> memoryview:
    """A file's bytes, memory-mapped. A file in a remote store is copied once per worker."""
    import mmap
    import tempfile

    from pyarrow import fs

    system, path = filesystem(uri)
    if not isinstance(system, fs.LocalFileSystem):
        copy = os.path.join(tempfile.gettempdir(), uri.replace("/", "_").replace(":", "_"))
        if not os.path.exists(copy):
            draft = f"{copy}.{uuid.uuid4().hex}"
            with system.open_input_stream(path, compression=None) as source, open(draft, "wb") as target:
                while chunk := source.read(1 << 22):
                    target.write(chunk)
            os.replace(draft, copy)
        path = copy
    if os.path.getsize(path) == 0:
        return memoryview(b"")
    with open(path, "rb") as handle:
        return memoryview(mmap.mmap(handle.fileno(), 0, access=mmap.ACCESS_READ))


def packed(arrays: dict) -> bytes:
    """Numpy arrays in one block that can be mapped: a JSON header, then each array at a multiple of 64."""
    import json

    import numpy as np

    places, at, parts = {}, 0, []
    for name, array in arrays.items():
        raw = np.ascontiguousarray(array)
        places[name] = (raw.dtype.str, len(raw), at)
        body = raw.tobytes()
        parts.append(body + b"\0" * (-len(body) % 64))
        at += len(parts[-1])
    header = json.dumps(places).encode()
    header += b" " * (-(len(header) + 8) % 64)
    return len(header).to_bytes(8, "little") + header + b"".join(parts)


def unpacked(data) -> dict:
    """The arrays of :func:`packed`, as views of the same memory."""
    import json

    import numpy as np

    n = int.from_bytes(bytes(data[:8]), "little")
    places = json.loads(bytes(data[8 : 8 + n]))
    return {
        name: np.frombuffer(data, dtype=kind, count=size, offset=8 + n + at) for name, (kind, size, at) in places.items()
    }
