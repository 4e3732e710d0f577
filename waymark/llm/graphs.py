"""Small networks as ONNX graphs, written in the few fields of the format that they need, and sessions that run them."""

from __future__ import annotations

import numpy as np

UINT8, FLOAT, INT32 = 2, 1, 6
_KINDS = {np.dtype(np.float32): FLOAT, np.dtype(np.int64): 7}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: int | str | bytes) -> bytes:
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    value = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def constant(name: str, a: np.ndarray) -> bytes:
    return b"".join(_field(1, n) for n in a.shape) + _field(2, _KINDS[a.dtype]) + _field(8, name) + _field(9, np.ascontiguousarray(a).tobytes())


def value(name: str, kind: int, *shape: int | str) -> bytes:
    """An input or output; sizes that are open have names."""
    sizes = b"".join(_field(1, _field(1 if isinstance(s, int) else 2, s)) for s in shape)
    return _field(1, name) + _field(2, _field(1, _field(1, kind) + _field(2, sizes)))


def node(kind: str, given: str, made: str, **settings: int | bytes) -> bytes:
    """One operation; names of what it is given and makes are separated by blanks, a setting in bytes is a graph."""
    at = [_field(1, k) + (_field(3, v) + _field(20, 2) if isinstance(v, int) else _field(6, v) + _field(20, 5)) for k, v in settings.items()]
    return b"".join([*(_field(1, x) for x in given.split()), *(_field(2, x) for x in made.split()), _field(4, kind), *(_field(5, a) for a in at)])


def graph(nodes: list[bytes], given: list[bytes], made: list[bytes], constants: tuple[bytes, ...] = ()) -> bytes:
    return b"".join([*(_field(1, n) for n in nodes), _field(2, "graph"), *(_field(5, c) for c in constants), *(_field(11, g) for g in given), *(_field(12, m) for m in made)])


def session(of: bytes):
    """A session of one thread, as Spark gives a task one core. It keeps what a run took: the workers' allocator gives all
    larger pieces back at once (``cluster.WORKERS``), and they would be paged in again for every step."""
    import onnxruntime  # only the processes that run a graph load it

    options = onnxruntime.SessionOptions()
    options.intra_op_num_threads = options.inter_op_num_threads = 1
    options.log_severity_level = 3
    return onnxruntime.InferenceSession(_field(1, 8) + _field(7, of) + _field(8, _field(2, 17)), options, providers=["CPUExecutionProvider"])
