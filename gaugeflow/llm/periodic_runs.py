"""Periodic runs of words by a dictionary of basic factors.

The basic factors of a text are its stretches of 1, 2, 4, 8, ... words. Each gets a name, so that two
of one length are equal exactly if their names are; a factor's name is made of those of its halves.
The occurrences of a name that follow each other within twice the length form arithmetic progressions
where the text is periodic: their difference is a period. What several neighbouring positions propose
alike is one run, which is extended word by word and kept once.

A run with smallest period q and at least 3q words is found at the one length L with q <= L < 2q: it
holds a factor of that length and its next occurrence, q further on. No occurrence lies between them,
as the run would then have a shorter period too. Factors that occur once in their text go, and with
them all longer ones that start there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text whose words share one dictionary; a longer text has its own.
SLICE_BYTES = 4_000_000

SCHEMA = (
    "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, "
    "n_kept long, collapsed string"
)


def _stretches(at: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last of neighbouring positions with the same gap, and that gap."""
    order = np.argsort(at)
    at, gap = at[order], gap[order]
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (np.diff(gap) != 0)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return at[first], at[last], gap[first]


def _extended(
    words: np.ndarray, begins: np.ndarray, ends: np.ndarray, start: np.ndarray, stop: np.ndarray, q: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Move both ends outwards while the words stay a period apart, inside the text."""
    start, stop = start.copy(), stop.copy()
    low, high = begins[start], ends[start]
    while len(grow := np.flatnonzero(start > low)):
        grow = grow[words[start[grow] - 1] == words[start[grow] - 1 + q[grow]]]
        if not len(grow):
            break
        start[grow] -= 1
    while len(grow := np.flatnonzero(stop < high)):
        grow = grow[words[stop[grow]] == words[stop[grow] - q[grow]]]
        if not len(grow):
            break
        stop[grow] += 1
    return start, stop


def runs(
    words: np.ndarray, sizes: np.ndarray, least: int = 24, times: int = 3
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and periods of all runs, by start and period.

    ``words`` are numbers of the words of several texts one after another, ``sizes`` how many each
    text has. A run lies in one text, and has ``least`` words and ``times`` periods at least.
    """
    closes = np.cumsum(sizes)
    begins, ends = np.repeat(closes - sizes, sizes), np.repeat(closes, sizes)
    longest = int(sizes.max(initial=0))
    at = np.arange(len(words))
    key = begins * (int(words.max(initial=0)) + 1) + words
    name = np.full(len(words), -1)
    found, length = [], 1
    while len(at) and times * length < 2 * longest:
        order = np.argsort(key, kind="stable")
        p, key = at[order], key[order]
        same = key[1:] == key[:-1]
        gap = p[1:] - p[:-1]
        near = same & (gap <= length) & (2 * gap > length)
        if near.any():
            first, last, q = _stretches(p[:-1][near], gap[near])
            stop = last + length + q
            long = stop - first >= np.maximum(least, times * q)
            if long.any():
                start, stop = _extended(words, begins, ends, first[long], stop[long], q[long])
                found.append(np.stack([start, q[long], stop - start]))
        twice = np.zeros(len(p), bool)
        twice[1:] |= same
        twice[:-1] |= same
        name.fill(-1)
        name[p[twice]] = np.append(0, np.cumsum(~same))[twice]
        at = np.sort(p[twice])
        at = at[at + 2 * length <= ends[at]]
        at = at[name[at + length] >= 0]
        key = name[at] * (len(words) + 1) + name[at + length]
        length *= 2
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    start, q, size = np.unique(np.concatenate(found, axis=1), axis=1)
    return start, size, q


def _sliced(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy())
    first = 0
    while first < batch.num_rows:
        before = sizes[first - 1] if first else 0
        until = max(first + 1, int(np.searchsorted(sizes, before + SLICE_BYTES, "right")))
        yield batch.slice(first, until - first)
        first = until


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, sizes = lists.flatten(), pc.list_value_length(lists).to_numpy()
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)  # white space at an end leaves empty ones
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return flat.filter(pa.array(real)), np.bincount(owner[real], minlength=len(sizes))


def _joined(words: pa.Array, sizes: np.ndarray) -> pa.Array:
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), words), " ")


def _measured(batch: pa.RecordBatch, least: int, times: int) -> pa.RecordBatch:
    words, sizes = _words(batch.column("text"))
    numbers = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    start, length, period = runs(numbers, sizes, least, times)
    closes = np.cumsum(sizes)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = np.cumsum(change[:-1]) == 0
    owner = np.repeat(np.arange(len(sizes)), sizes)
    n_kept = np.bincount(owner[kept], minlength=len(sizes))
    of = np.searchsorted(closes, start, "right")
    local = start - (closes - sizes)[of] if len(of) else start
    structs = pa.StructArray.from_arrays(
        [pa.array(local), pa.array(length), pa.array(period)], ["start", "length", "period"]
    )
    per_text = np.append(0, np.cumsum(np.bincount(of, minlength=len(sizes)))).astype(np.int32)
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": batch.column("doc_id"),
            "n_words": pa.array(sizes, pa.int64()),
            "runs": pa.ListArray.from_arrays(pa.array(per_text), structs),
            "n_kept": pa.array(n_kept, pa.int64()),
            "collapsed": _joined(words.filter(pa.array(kept)), n_kept),
        }
    )


def periodic_runs(docs: DataFrame, least: int = 24, times: int = 3) -> DataFrame:
    """All runs of every ``text``, and the text without what they repeat.

    ``doc_id, n_words, runs, n_kept, collapsed``. Words are stretches of other than ASCII white space.
    A run has at least ``least`` words and ``times`` of its smallest period. ``collapsed`` are the
    ``n_kept`` words that no run contains after its first period, joined by one space. Null, empty and
    white texts have no words. Every row is a text of its own, also where ``doc_id`` is repeated or
    null; other columns are not read. An empty table gives an empty result.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _sliced(batch):
                yield _measured(part, least, times)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(found, SCHEMA)


def digests(found: DataFrame) -> DataFrame:
    """Per row of :func:`periodic_runs`: how many runs, the strongest one, digests of runs and text.

    The strongest run has the greatest ``length / period``, then the smallest start, then the smallest
    period; its four columns are null without a run. Quotients of doubles keep the order of the exact
    ones while length times period is below 2^50.
    """
    listed = F.expr("""concat_ws('', transform(array_sort(transform(runs, r -> struct(r.start, r.period, r.length))),
        r -> concat(r.start, ',', r.length, ',', r.period, '\n')))""")
    strongest = F.expr("""array_min(transform(runs, r -> struct(
        -(cast(r.length AS double) / r.period) AS weakness, r.start, r.period, r.length)))""")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        strongest.alias("best"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
