"""MD5 and CRC32C, both base64; the CRC in big-endian byte order.

MD5 is a built-in. Spark's ``crc32`` uses another polynomial, so CRC32C is an Arrow-batched
function. A CRC is linear, which gives two things used here: bytes are cut into fixed lanes
that numpy folds side by side, and the CRCs of file ranges read by different tasks combine
into the CRC of the whole file.
"""

from __future__ import annotations

import base64
import functools
import struct
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, types as T
from pyspark.sql import functions as F

# The reflected Castagnoli polynomial, the lane width in bytes, and how many
# bytes are folded together at a time.
POLYNOMIAL = 0x82F63B78
LANE = 256
FOLD_BYTES = 32 * 1024 * 1024


@functools.lru_cache(maxsize=1)
def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1)
    return table.astype(np.uint32)


@functools.lru_cache(maxsize=128)
def _shift_tables(power: int) -> np.ndarray:
    """Four 256-entry tables that append ``2**power`` zero bytes to a CRC register."""
    if power == 0:
        single = np.uint32(1) << np.arange(32, dtype=np.uint32)
        moved = _byte_table()[single & 0xFF] ^ (single >> np.uint32(8))
    else:
        half = _shift_tables(power - 1)
        single = np.uint32(1) << np.arange(32, dtype=np.uint32)
        moved = _apply(half, _apply(half, single))
    values = np.arange(256, dtype=np.uint32)
    tables = np.zeros((4, 256), dtype=np.uint32)
    for part in range(4):
        for bit in range(8):
            chosen = (values >> np.uint32(bit)) & 1
            tables[part] ^= np.where(chosen == 1, moved[part * 8 + bit], 0).astype(np.uint32)
    return tables


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return (tables[0][crc & 0xFF] ^ tables[1][(crc >> np.uint32(8)) & 0xFF]
            ^ tables[2][(crc >> np.uint32(16)) & 0xFF] ^ tables[3][crc >> np.uint32(24)])


def _shift(crc: int, n_bytes: int) -> int:
    value = np.array([crc], dtype=np.uint32)
    power = 0
    while n_bytes:
        if n_bytes & 1:
            value = _apply(_shift_tables(power), value)
        n_bytes >>= 1
        power += 1
    return int(value[0])


def _shift_each(crc: int, n_bytes: np.ndarray) -> np.ndarray:
    """One register moved over a different number of zero bytes per entry."""
    values = np.full(len(n_bytes), crc, dtype=np.uint32)
    for power in range(int(n_bytes.max(initial=0)).bit_length()):
        moved = (n_bytes >> power) & 1 == 1
        values[moved] = _apply(_shift_tables(power), values[moved])
    return values


def crc32c_many(values: list[bytes]) -> list[int]:
    """CRC32C of each value; the lanes of the whole batch are folded together."""
    table = _byte_table()
    sizes = np.array([len(v) for v in values], dtype=np.int64)
    lanes = -(-sizes // LANE)
    # leading zero bytes do not change a register that starts at zero
    padded = b"".join(bytes(int(n) * LANE - len(v)) + v for v, n in zip(values, lanes))
    grid = np.ascontiguousarray(np.frombuffer(padded, dtype=np.uint8).reshape(-1, LANE).T)
    register = np.zeros(grid.shape[1], dtype=np.uint32)
    for position in range(LANE):
        register = table[(register ^ grid[position]) & 0xFF] ^ (register >> np.uint32(8))
    # join neighbouring lanes of each value, pairwise, until every value has one register
    power = LANE.bit_length() - 1
    while lanes.max(initial=0) > 1:
        odd = lanes % 2
        starts = np.cumsum(lanes) - lanes
        register = np.insert(register, starts[odd == 1], 0)
        register = _apply(_shift_tables(power), register[0::2]) ^ register[1::2]
        lanes = (lanes + odd) // 2
        power += 1
    raw = np.zeros(len(values), dtype=np.uint32)
    raw[lanes == 1] = register
    return (raw ^ _shift_each(0xFFFFFFFF, sizes) ^ np.uint32(0xFFFFFFFF)).tolist()


def combine(left: int, right: int, right_length: int) -> int:
    """CRC32C of two joined byte strings from the CRC of each."""
    return _shift(left, right_length) ^ right


def crc32c_of(chunks: Iterable[bytes]) -> int:
    """CRC32C of the joined chunks; one at a time is held and folded."""
    crc = 0
    for chunk in chunks:
        crc = combine(crc, crc32c_many([chunk])[0], len(chunk))
    return crc


def to_base64(crc: int) -> str:
    return base64.b64encode(struct.pack(">I", crc)).decode("ascii")


@F.pandas_udf(T.StringType())
def _crc32c_base64(content: pd.Series) -> pd.Series:
    present = content.notna()
    out = pd.Series([None] * len(content), index=content.index, dtype=object)
    sums: list[int] = []
    waiting: list[bytes] = []
    size = 0
    for value in content[present]:
        waiting.append(bytes(value))
        size += len(value)
        if size >= FOLD_BYTES:
            sums += crc32c_many(waiting)
            waiting, size = [], 0
    out[present] = [to_base64(c) for c in sums + crc32c_many(waiting)]
    return out


@F.pandas_udf(T.StringType())
def fold_ranges(parts: pd.Series) -> pd.Series:
    """Joins per-range ``(position, length, crc)`` entries, already in order, into one CRC."""
    def fold(entries) -> str:
        crc = 0
        for entry in entries:
            crc = combine(crc, int(entry["crc"]), int(entry["length"]))
        return to_base64(crc)
    return parts.map(fold)


def crc32c(content: Column) -> Column:
    return _crc32c_base64(content.cast("binary"))


def md5(content: Column) -> Column:
    return F.base64(F.unhex(F.md5(content.cast("binary"))))
