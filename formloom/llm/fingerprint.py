"""SimHash fingerprints as numbers: majority bits, distances, and groups of rows that arrive together."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa

BITS = np.array([bin(i).count("1") for i in range(1 << 16)], np.uint8)


def majority(hashes: np.ndarray) -> int:
    """The number whose bits are those set in over half of the hashes; zero of none."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a ^ b
    return sum(BITS[(x >> np.uint64(s)) & np.uint64(0xFFFF)] for s in (0, 16, 32, 48))


def spanning(pairs: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Those of the pairs that join something new, in their order."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root.setdefault(up, up)
        return x

    out = []
    for a, b in pairs:
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def by_group(batches: Iterable[pa.RecordBatch], keys: Sequence[str], rows: int = 1 << 15) -> Iterator[dict]:
    """The rows of each group, which arrive one after the other: numbers as arrays, bytes as lists. About `rows` rows or one
    whole group are held at once."""
    held: list[pa.RecordBatch] = []

    def columns() -> tuple[dict, np.ndarray]:
        table = pa.Table.from_batches(held)
        cols = {n: table[n].to_pylist() if pa.types.is_binary(table.schema.field(n).type) else table[n].to_numpy() for n in table.column_names}
        new = np.any([cols[k][1:] != cols[k][:-1] for k in keys], axis=0)
        return cols, np.concatenate(([0], np.flatnonzero(new) + 1, [table.num_rows]))

    def cut(cols: dict, at: np.ndarray) -> Iterator[dict]:
        for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            yield {n: c[x:y] for n, c in cols.items()}

    n, wait = 0, rows
    for b in batches:
        if b.num_rows:
            held.append(b)
            n += b.num_rows
        if n >= wait:
            cols, at = columns()
            yield from cut(cols, at[:-1])
            last = int(at[-2])
            held = pa.Table.from_batches(held).slice(last).combine_chunks().to_batches()
            n -= last
            wait = rows + 2 * n  # a large group is put together a few times, not once for each batch
    if n:
        yield from cut(*columns())


def pairs_within(values: np.ndarray, group: np.ndarray, table: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Pairs (places i < j) of one group whose values differ in `most` bits or fewer, with how many pairs met and how many
    the pivots left to be verified.

    group: of each value, equal ones together. table: a row of distances to the values for each pivot. Rows are compared
    with those 1, 2, ... places further on; a pair whose distances to some pivot differ by more than `most` is discarded.
    """
    met = left = 0
    first, second, step = [], [], 1
    while step < len(values):
        i = np.flatnonzero(group[step:] == group[:-step])
        if not len(i):
            break
        met += len(i)
        for row in table:
            i = i[np.abs(row[i + step] - row[i]) <= most]
        left += len(i)
        i = i[hamming(values[i], values[i + step]) <= most]
        first.append(i)
        second.append(i + step)
        step += 1
    none = np.zeros(0, np.int64)
    return np.concatenate(first or [none]), np.concatenate(second or [none]), met, left
