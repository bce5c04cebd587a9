"""Which keys stand in more than one sender: sorted runs go to owners, bits come back.

A sender is a stored row with many keys. It sends each owner (a range of keys) one sorted run; an owner
merges its runs and answers with a bit per key. Keys are spread evenly by being hashes, and a key that
is frequent anywhere is sent once by each sender, so no key is hot. There are as many owners as keep
``OWNED`` keys each, so an owner's memory doesn't grow with the data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from tickloom.llm.tables import parts

#: (sorted distinct 64-bit keys, 64 more bits of each or None) of a sender's row.
Keys = Callable[[dict], tuple[np.ndarray, np.ndarray | None]]
#: Keys of one owner, about.
OWNED = 3_000_000


def owners_of(senders: DataFrame, keys: int) -> int:
    """How many owners that many keys of all senders need; at least one for each shuffle partition."""
    return max(parts(senders.sparkSession), -(-keys // OWNED))


def cuts(keys: np.ndarray, owners: int) -> np.ndarray:
    """Bounds, in sorted ``keys``, of what each owner gets."""
    bounds = [np.uint64(i * (1 << 64) // owners) for i in range(owners)]
    return np.append(np.searchsorted(keys, np.array(bounds, dtype=np.uint64)), len(keys))


def distinct(keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct (key, check) pairs, and the number of the pair that each entry equals."""
    order = np.lexsort((checks, keys))
    k, c = keys[order], checks[order]
    new = np.ones(len(k), dtype=bool)
    new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    which = np.empty(len(k), dtype=np.int64)
    which[order] = np.cumsum(new) - 1
    return k[new], c[new], which


def _answer(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    runs = [np.frombuffer(x, "<u8") for x in group["run"]]
    if group["checks"].notna().any():
        k, _, which = distinct(np.concatenate(runs), np.concatenate([np.frombuffer(x, "<u8") for x in group["checks"]]))
    else:
        k, which = np.unique(np.concatenate(runs), return_inverse=True)
    shared = np.bincount(which, minlength=len(k)) > 1
    ends = np.cumsum([len(r) for r in runs])
    bits = [np.packbits(x).tobytes() for x in np.split(shared[which], ends[:-1])]
    return pd.DataFrame({"sender": group["sender"], "owner": key[0], "bits": bits})


def answers(runs: DataFrame) -> DataFrame:
    """runs: owner, sender, run, checks. Result: sender, owner, bits."""
    return runs.groupBy("owner").applyInPandas(_answer, "sender long, owner int, bits binary")


def sent(senders: DataFrame, keys: Keys, owners: int) -> DataFrame:
    """The runs of stored ``senders`` (with a column ``sender``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own, checks = keys(row)
                at = cuts(own, owners)
                full = np.flatnonzero(np.diff(at))
                columns = [
                    pa.array(full, pa.int32()),
                    pa.array([row["sender"]] * len(full), pa.int64()),
                    pa.array([own[at[o] : at[o + 1]].astype("<u8").tobytes() for o in full], pa.binary()),
                    pa.array([None if checks is None else checks[at[o] : at[o + 1]].astype("<u8").tobytes() for o in full], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["owner", "sender", "run", "checks"])

    return senders.mapInArrow(run, "owner int, sender long, run binary, checks binary")


def received(replies: pd.DataFrame, keys: np.ndarray, owners: int) -> np.ndarray:
    """For each of a sender's sorted distinct keys: does another sender have it?"""
    at = cuts(keys, owners)
    bits = dict(zip(replies["owner"], replies["bits"], strict=True))
    flags = [np.unpackbits(np.frombuffer(bits[o], np.uint8), count=at[o + 1] - at[o]) for o in np.flatnonzero(np.diff(at))]
    return np.concatenate([np.zeros(0, np.uint8), *flags]).astype(bool)
