"""Masked pseudo-likelihood: every word predicted from the words on both sides.

A small window network, written and trained in numpy, looks at two words before and two after a
masked one. Its output is a softmax over classes of words and one over the words of the class. A
document's score is the sum of the log probabilities of all its words, each given its neighbours.

The most frequent words have an output of their own. All others share some, by hash; such a word's
probability is that of its output times the word's share of it, which is taken from the counts of all
words of the corpus, with some mass left for words that never occur. So the probabilities of all
words add up to one, and what is kept of the corpus grows with it.

Words are counted over all documents. Training goes over all of them in rounds: in each, every
partition starts from the shared parameters and learns from all positions of its own documents, or
from a share of them if a caller asks for that; the results are averaged, weighted by positions, in two steps, so no task meets those of
all partitions. What is collected is one set of parameters, whatever the size of the corpus.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.tokens import _Kept
from gaugeflow.session import write_out

#: Words in a class, classes, and how many of the words stand for all others, by hash.
IN_CLASS, CLASSES, OTHERS = 64, 64, 64
VOCABULARY = IN_CLASS * CLASSES
#: Words looked at on either side, and sizes of a word's and of the hidden layer.
SIDE, WORD, HIDDEN = 2, 24, 48
#: Stands beside the first and the last word.
EDGE = VOCABULARY
#: Positions in a training step, and positions scored at once.
STEP, CHUNK = 8192, 1 << 15
#: Numbers of a parameter vector in a row.
BLOCK = 1 << 14
#: Added to the count of every word that shares an output, and the count of all words never met.
SMOOTH = 0.5

_SHAPES = {
    "words": (VOCABULARY + 1, WORD),
    "hidden": (2 * SIDE * WORD, HIDDEN),
    "hidden_bias": (HIDDEN,),
    "classes": (HIDDEN, CLASSES),
    "class_bias": (CLASSES,),
    "members": (CLASSES, HIDDEN, IN_CLASS),
    "member_bias": (CLASSES, IN_CLASS),
}


@dataclass(frozen=True)
class WindowNetwork:
    """The known words, most frequent first, and the parameters by the names of ``_SHAPES``."""

    vocabulary: tuple[str, ...]
    weights: dict[str, np.ndarray]

    def ids(self) -> _Kept:
        """Word -> id; words that are not known share the last ids by their hash."""
        first = VOCABULARY - OTHERS
        known = {w: i for i, w in enumerate(self.vocabulary)}
        return _Kept(
            lambda w: known.get(w, first + zlib.crc32(w.encode("utf-8", "surrogatepass")) % OTHERS),
            400_000,
        )

    def log_probabilities(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Log probability of each target id, given its row of ``context`` ids."""
        w = self.weights
        order, classes = _by_class(target // IN_CLASS)
        context, target = np.take(context, order, axis=0), target[order]
        hidden = np.tile(w["hidden_bias"], (len(target), 1))
        for beside, part in zip(context.T, np.split(w["hidden"], 2 * SIDE), strict=True):
            hidden += np.take(w["words"] @ part, beside, axis=0)
        np.tanh(hidden, out=hidden)
        found = _log_share(hidden @ w["classes"] + w["class_bias"], target // IN_CLASS)
        for k, of in classes:
            found[of] += _log_share(hidden[of] @ w["members"][k] + w["member_bias"][k], target[of] % IN_CLASS)
        out = np.empty(len(target))
        out[order] = found
        return out


def _log_share(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log of the softmax of each row of ``x``, which is overwritten, at one place."""
    x -= x.max(axis=1, keepdims=True)
    chosen = x[np.arange(len(x)), at].astype(float)
    np.exp(x, out=x)
    return chosen - np.log(x @ np.ones(x.shape[1], x.dtype))


def _error(x: np.ndarray, at: np.ndarray, scale: float) -> np.ndarray:
    """The softmax of each row, less one at one place, times ``scale``; made in ``x`` itself."""
    x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    x *= (scale / (x @ np.ones(x.shape[1], x.dtype)))[:, None]
    x[np.arange(len(x)), at] -= scale
    return x


def _by_class(of: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """An order by class, and where each class that occurs lies in it."""
    ends = np.bincount(of, minlength=CLASSES).cumsum().tolist()
    parts = [(k, slice(ends[k - 1] if k else 0, ends[k])) for k in range(CLASSES)]
    return np.argsort(of.astype(np.int16), kind="stable"), [(k, p) for k, p in parts if p.start < p.stop]


def _positions(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, context and target of every position of some documents' ids."""
    padded = np.full(sum(len(r) for r in rows) + SIDE * (len(rows) + 1), EDGE, np.int64)
    places, at = [], SIDE
    for r in rows:
        padded[at : at + len(r)] = r
        places.append(np.arange(at, at + len(r)))
        at += len(r) + SIDE
    place = np.concatenate(places) if places else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    beside = [d for d in range(-SIDE, SIDE + 1) if d]
    return owner, padded[place[:, None] + np.array(beside)], padded[place]


def _learn(
    weights: dict[str, np.ndarray],
    squares: dict[str, np.ndarray],
    context: np.ndarray,
    target: np.ndarray,
    rate: float,
) -> None:
    """One step, scaled by the root of each parameter's summed squared gradients."""
    w, size = weights, len(target)

    def move(name: str, gradient: np.ndarray, at: object = ...) -> None:
        total = squares[name][at] + gradient * gradient
        squares[name][at] = total
        w[name][at] -= rate * gradient / np.sqrt(total)

    order, classes = _by_class(target // IN_CLASS)
    context, target = np.take(context, order, axis=0), target[order]
    looked = np.take(w["words"], context, axis=0).reshape(size, -1)
    hidden = looked @ w["hidden"]
    hidden += w["hidden_bias"]
    np.tanh(hidden, out=hidden)
    outer = hidden @ w["classes"]
    outer += w["class_bias"]
    _error(outer, target // IN_CLASS, 1 / size)
    back = outer @ w["classes"].T
    for k, of in classes:
        inner = hidden[of] @ w["members"][k]
        inner += w["member_bias"][k]
        _error(inner, target[of] % IN_CLASS, 1 / size)
        back[of] += inner @ w["members"][k].T
        move("members", hidden[of].T @ inner, k)
        move("member_bias", inner.sum(axis=0), k)
    move("classes", hidden.T @ outer)
    move("class_bias", outer.sum(axis=0))
    hidden *= hidden
    np.subtract(1, hidden, out=hidden)
    back *= hidden
    word = w["hidden"] @ back.T
    move("hidden", looked.T @ back)
    move("hidden_bias", back.sum(axis=0))
    sums = np.zeros((WORD, VOCABULARY + 1))
    for beside, part in zip(np.ascontiguousarray(context.T), np.split(word, 2 * SIDE), strict=True):
        for total, each in zip(sums, part, strict=True):
            total += np.bincount(beside, each, VOCABULARY + 1)
    met = np.flatnonzero(np.bincount(context.ravel(), minlength=VOCABULARY + 1))
    move("words", sums.T[met].astype(np.float32), met)


def _flat(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[name].ravel() for name in _SHAPES])


def _unflat(flat: np.ndarray) -> dict[str, np.ndarray]:
    ends = np.cumsum([int(np.prod(shape)) for shape in _SHAPES.values()])
    parts = np.split(flat.astype(np.float32), ends[:-1])
    return {n: p.reshape(s).copy() for (n, s), p in zip(_SHAPES.items(), parts, strict=True)}


def _start(counts: list[tuple[str, int]], total: int, seed: int) -> WindowNetwork:
    """Small random weights, with biases that give every word its frequency."""
    rng = np.random.default_rng(seed)
    weights = {
        name: rng.normal(0, 0.1, shape).astype(np.float32) for name, shape in _SHAPES.items()
    }
    seen = np.full(VOCABULARY, 0.5)
    seen[: len(counts)] += [n for _, n in counts]
    seen[VOCABULARY - OTHERS :] += (total - sum(n for _, n in counts)) / OTHERS
    seen = seen.reshape(CLASSES, IN_CLASS)
    weights["class_bias"] = np.log(seen.sum(axis=1)).astype(np.float32)
    weights["member_bias"] = np.log(seen).astype(np.float32)
    weights["hidden_bias"][:] = 0
    return WindowNetwork(tuple(w for w, _ in counts), weights)


def _words() -> Column:
    text = F.lower(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return F.filter(F.split(text, r"[ \t\n\r\x0b\x0c]+"), lambda w: w != "")


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n`` of all words of all documents."""
    counts = docs.select(F.explode(_words()).alias("word")).groupBy("word").agg(
        F.count("*").alias("n")
    )
    return write_out(counts, "word-counts")


def count_words(
    docs: DataFrame, seed: int = 7, counts: DataFrame | None = None
) -> WindowNetwork:
    """An untrained network that knows the most frequent words of all documents."""
    counts = word_counts(docs) if counts is None else counts
    total = counts.agg(F.sum("n")).first()[0] or 0
    top = counts.orderBy(F.desc("n"), "word").limit(VOCABULARY - OTHERS).collect()
    return _start([(r["word"], r["n"]) for r in top], total, seed)


def numbered(docs: DataFrame, network: WindowNetwork) -> DataFrame:
    """``doc_id`` and ``ids``, two bytes each, of the words of every ``text``.

    ``row`` numbers the rows, and ``others`` has the words that share an output, a space between two.
    """
    model = docs.sparkSession.sparkContext.broadcast(network.vocabulary)
    shared = VOCABULARY - OTHERS

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_of = WindowNetwork(model.value, {}).ids()
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            found, others = [], []
            for text in batch.column("text"):
                words = _split(text.as_py())
                each = np.fromiter(map(id_of.__getitem__, words), "<u2", len(words))
                found.append(each.tobytes())
                others.append(" ".join([words[i] for i in np.flatnonzero(each >= shared)]))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "ids": pa.array(found, pa.binary()),
                    "row": np.arange(first, first + len(found)),
                    "others": pa.array(others, pa.string()),
                }
            )
            first += len(found)

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(ids, "doc_id long, ids binary, row long, others string")


def shares(counts: DataFrame, network: WindowNetwork) -> DataFrame:
    """``word, share``: log of the share that each word has of the output it shares with others.

    A null ``word`` for each ``output`` has that of all words that never occur.
    """
    spark = counts.sparkSession
    known = spark.createDataFrame([(w,) for w in network.vocabulary], "word string")
    rows = counts.join(F.broadcast(known), "word", "left_anti")
    rows = rows.withColumn("output", F.crc32(F.col("word").cast("binary")) % OTHERS)
    every = spark.range(OTHERS).select(
        F.lit(None).cast("string").alias("word"), F.lit(0).cast("long").alias("n"), F.col("id").alias("output")
    )
    rows = rows.unionByName(every)
    total = rows.groupBy("output").agg(F.sum(F.col("n") + SMOOTH).alias("total"))
    share = F.log((F.col("n") + SMOOTH) / F.col("total")).alias("share")
    return rows.join(F.broadcast(total), "output").select("word", "output", share)


def within_outputs(numbers: DataFrame, shared: DataFrame) -> DataFrame:
    """``row, within``: sum of the :func:`shares` of the words of a row that share an output."""
    words = numbers.select("row", F.explode(F.split("others", " ")).alias("word")).where("word != ''")
    met = shared.where("word IS NOT NULL").select("word", "share")
    never = shared.where("word IS NULL").select("output", F.col("share").alias("never"))
    found = words.join(met, "word", "left")
    found = found.withColumn("output", F.crc32(F.col("word").cast("binary")) % OTHERS)
    found = found.join(F.broadcast(never), "output")
    return found.groupBy("row").agg(F.sum(F.coalesce("share", "never")).alias("within"))


def _split(text: str | None) -> list[str]:
    """The words as :func:`_words` gives them."""
    for space in "\t\n\r\x0b\x0c":
        text = (text or "").replace(space, " ")
    return [w for w in text.lower().split(" ") if w]


def _documents(
    batches: Iterator[pa.RecordBatch],
) -> Iterator[tuple[list, list[int], list[np.ndarray]]]:
    """Ids of documents, about :data:`CHUNK` words at a time; a document is never split."""
    names, places, rows, waiting = [], [], [], 0
    for batch in batches:
        each = (batch.column(c).to_pylist() for c in ("doc_id", "row", "ids"))
        for name, place, ids in zip(*each, strict=True):
            names.append(name)
            places.append(place)
            rows.append(np.frombuffer(ids, "<u2").astype(np.int64))
            waiting += len(rows[-1])
            if waiting >= CHUNK:
                yield names, places, rows
                names, places, rows, waiting = [], [], [], 0
    if names:
        yield names, places, rows


def train(
    numbers: DataFrame, network: WindowNetwork, rounds: int = 2, one_in: int = 1, rate: float = 0.1
) -> WindowNetwork:
    """``network`` after ``rounds`` over all documents.

    A round takes every position as a target, or a random one in ``one_in`` of them. Without
    documents, or words in them, the network stays as it is; equal rows teach each.
    """
    context_ = numbers.sparkSession.sparkContext

    for turn in range(rounds):
        shared = context_.broadcast(_flat(network.weights).astype("<f4"))

        def learned(
            batches: Iterator[pa.RecordBatch], turn: int = turn, shared=shared
        ) -> Iterator[pa.RecordBatch]:
            weights = _unflat(shared.value)
            squares = {name: np.full(shape, 1e-6, np.float32) for name, shape in _SHAPES.items()}
            part = TaskContext.get().partitionId()
            masks, done = np.random.default_rng([turn, part]), 0
            for *_, rows in _documents(batches):
                _, context, target = _positions(rows)
                if one_in > 1:
                    chosen = np.flatnonzero(masks.random(len(target)) < 1 / one_in)
                    context, target = context[chosen], target[chosen]
                for at in range(0, len(target), STEP):
                    some = slice(at, at + STEP)
                    _learn(weights, squares, context[some], target[some], rate)
                done += len(target)
            if done:
                flat = _flat(weights) * np.float64(done)
                blocks = [flat[i : i + BLOCK].astype("<f8").tobytes() for i in range(0, len(flat), BLOCK)]
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": list(range(len(blocks))),
                        "salt": [part % 256] * len(blocks),
                        "n": [done] * len(blocks),
                        "sums": pa.array(blocks, pa.binary()),
                    }
                )

        sql = "block long, salt long, n long, sums binary"
        parts = numbers.select("doc_id", "ids", "row").mapInArrow(learned, sql)
        some = parts.groupBy("block", "salt").applyInArrow(_summed, sql)
        total = some.groupBy("block").applyInArrow(_summed, sql).orderBy("block").collect()
        if total:  # one set of parameters
            flat = np.concatenate([np.frombuffer(r["sums"], "<f8") / r["n"] for r in total])
            network = replace(network, weights=_unflat(flat))
    return network


def _summed(rows: pa.Table) -> pa.Table:
    total = np.zeros(len(rows.column("sums")[0].as_py()) // 8)
    for sums in rows.column("sums"):
        total += np.frombuffer(sums.as_py(), "<f8")
    return pa.table(
        {
            "block": [rows.column("block")[0].as_py()],
            "salt": [rows.column("salt")[0].as_py()],
            "n": [sum(rows.column("n").to_pylist())],
            "sums": pa.array([total.tobytes()], pa.binary()),
        }
    )


def score(
    numbers: DataFrame, network: WindowNetwork, within: DataFrame | None = None
) -> DataFrame:
    """``doc_id, n_words, log_prob, mean_log_prob`` of every row of :func:`numbered`.

    The probabilities are those of the network's outputs; with ``within``, the rows' sums of
    :func:`within_outputs`, they are those of the words. A document without words has a ``log_prob``
    of 0 and no mean. Repeated rows and null ids are scored as they are.
    """
    if within is not None:
        rows = _scored(numbers, network).join(within, "row", "left")
        total = F.col("log_prob") + F.coalesce("within", F.lit(0.0))
        mean = F.when(F.col("n_words") > 0, total / F.col("n_words"))
        return rows.select(
            "doc_id", "n_words", total.alias("log_prob"), mean.alias("mean_log_prob")
        )
    return _scored(numbers, network).drop("row")


def _scored(numbers: DataFrame, network: WindowNetwork) -> DataFrame:
    """Scores by the network's outputs, and ``row``."""
    model = numbers.sparkSession.sparkContext.broadcast(network)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, places, rows in _documents(batches):
            owner, context, target = _positions(rows)
            total = np.zeros(len(rows))
            for at in range(0, len(target), CHUNK):
                part = slice(at, at + CHUNK)
                each = model.value.log_probabilities(context[part], target[part])
                total += np.bincount(owner[part], each, len(rows))
            count = np.array([len(r) for r in rows])
            mean = pa.array(total / np.maximum(count, 1), mask=count == 0)
            yield pa.RecordBatch.from_pydict(
                {
                    "row": places,
                    "doc_id": pa.array(names, pa.int64()),
                    "n_words": count,
                    "log_prob": total,
                    "mean_log_prob": mean,
                }
            )

    sql = "row long, doc_id long, n_words long, log_prob double, mean_log_prob double"
    return numbers.select("doc_id", "ids", "row").mapInArrow(scored, sql)


def pseudo_likelihood(docs: DataFrame, rounds: int = 2, one_in: int = 1) -> DataFrame:
    """Scores of all ``docs`` by a network trained on them; see :func:`score`.

    Only ``doc_id`` and ``text`` are read, and an empty table gives an empty one.
    """
    counts = word_counts(docs)
    network = count_words(docs, counts=counts)
    numbers = write_out(numbered(docs, network), "numbered-words")
    within = within_outputs(numbers, write_out(shares(counts, network), "word-shares"))
    return score(numbers, train(numbers, network, rounds, one_in), within)
