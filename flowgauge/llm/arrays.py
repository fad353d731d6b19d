"""Sorted arrays in the shared folder: written whole under their final name, memory-mapped where the folder is mounted."""

import os
import uuid

import numpy as np

SMALL = 1 << 20


def _local(folder: str) -> str | None:
    if folder.startswith("file:"):
        return folder.removeprefix("file:").replace("//", "/", 1) if folder.startswith("file://") else folder[5:]
    return None if "://" in folder else folder


def save(folder: str, name: str, values: np.ndarray) -> None:
    """A task that runs again replaces its file by an equal one; readers never see half a file."""
    path = _local(folder)
    if path is None:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        with store.open_output_stream(f"{root}/{name}.npy") as out:
            np.save(out, values, allow_pickle=False)
        return
    os.makedirs(path, exist_ok=True)
    part = f"{path}/.{name}-{uuid.uuid4().hex}"
    with open(part, "wb") as out:
        np.save(out, values, allow_pickle=False)
    os.replace(part, f"{path}/{name}.npy")


def load(folder: str, name: str) -> np.ndarray:
    """Memory-mapped from a mounted folder; read whole from a store that has no paths."""
    path = _local(folder)
    if path is None:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        with store.open_input_file(f"{root}/{name}.npy") as stream:
            return np.load(stream, allow_pickle=False)
    file = f"{path}/{name}.npy"
    return np.load(file, mmap_mode="r" if os.path.getsize(file) > SMALL else None, allow_pickle=False)


def planes(values: np.ndarray) -> bytes:
    """Bytes by significance: the high, mostly zero ones lie together, where the shuffle's compression removes them."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def from_planes(raw: bytes, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(dtype).reshape(-1)


def ascending(values: np.ndarray) -> bytes:
    """Ascending unsigned 64-bit numbers as planes of their differences."""
    return planes(np.diff(values, prepend=values.dtype.type(0)))


def from_ascending(raw: bytes) -> np.ndarray:
    return np.cumsum(from_planes(raw, "<u8"), dtype=np.uint64)


def merge(keys: list[np.ndarray], *columns: list[np.ndarray]) -> list[np.ndarray]:
    """Distinct ascending keys and, for each column, the sums of its values by key."""
    joined = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
    order = np.argsort(joined, kind="stable")
    joined = joined[order]
    first = np.nonzero(np.concatenate([[True], joined[1:] != joined[:-1]]))[0] if len(joined) else np.zeros(0, np.int64)
    sums = [np.add.reduceat(np.concatenate(c).astype(np.int64)[order], first) if len(joined) else np.zeros(0, np.int64)
            for c in columns]
    return [joined[first], *sums]
