"""Near duplicates by the weighted Jaccard similarity of word shingles, with BagMinHash signatures.

A document is the bag of its shingles of five words. Every shingle carries a Poisson process over
(weight, time); a document with the shingle ``c`` times sees the points up to weight ``c``. Each
point belongs to one of the signature's components, which keeps its earliest point. Two documents
share it with a probability of exactly their weighted Jaccard similarity. Weights are split into
levels (0, 1], (1, 2], (2, 4], ... with one process each, whose points are thinned in the last level,
so a shingle's cost grows with the logarithm of its count; points are drawn up to a time by which all
components have one, so most shingles need no more than one draw.

Signatures are cut into bands, and documents that agree in a band share a bucket. Every bucket
compares its members with one of them; agreement of the bags is verified on the texts. Buckets that
are still in more than one class compare another member with those of other classes, and what is then
still in more than one class compares its members in blocks within tasks, so that no pair in a
bucket is left out and none is emitted that doesn't join two classes. Classes are connected
components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.arrays import packed, unpacked
from gaugeflow.llm.tokens import _Kept
from gaugeflow.session import write_out

#: Words in a shingle, and the similarity from which documents are near duplicates.
SHINGLE, SIMILAR = 5, 0.8
#: Bands, and components in a band: documents of similarity 0.8 miss all buckets once in 300 000.
BANDS, ROWS = 32, 5
PLACES = BANDS * ROWS
#: Signatures of near duplicates agree in this share of components, but five times in a million.
AGREE = 0.66
#: Members of a bucket in a block; a task holds two blocks, texts included.
BLOCK = 1024
#: Shingles that are drawn for at once.
CHUNK = 100_000

_U = np.uint64
_words = _Kept(lambda w: xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")), 800_000)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def bag_of(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the shingles of a text, in lower case; a shorter text is one shingle."""
    words = (text or "").lower().split()
    if not words:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    each = np.fromiter(map(_words.__getitem__, words), _U, len(words))
    size = min(SHINGLE, len(words))
    h = np.zeros(len(words) - size + 1, _U)
    for i in range(size):
        h = _mix(h * _U(0x9E3779B97F4A7C15) + each[i : i + len(h)])
    return np.unique(h, return_counts=True)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """One row of :data:`PLACES` 32-bit values per bag; an empty bag has zeros."""
    count = len(bags)
    values = np.zeros(count * PLACES, np.uint32)
    best = np.full(count * PLACES, np.inf)
    owner = np.repeat(np.arange(count), [len(h) for h, _ in bags])
    h = np.concatenate([h for h, _ in bags]) if bags else np.zeros(0, _U)
    c = np.concatenate([c for _, c in bags]) if bags else np.zeros(0, np.int64)
    total = np.bincount(owner, c, count)
    # one process per shingle and level of its count
    levels = 1 + np.ceil(np.log2(np.maximum(c, 1))).astype(np.int64)
    at = np.repeat(np.arange(len(h)), levels)
    level = np.arange(len(at)) - np.repeat(levels.cumsum() - levels, levels)
    start = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    width = np.maximum(start, 1).astype(float)
    seen = (c[at] - start) / width  # share of the level that the document sees
    owner = owner[at]
    state = _mix(h[at] + level.astype(_U) * _U(0xD1B54A32D192ED03))
    time = np.zeros(len(at))

    def draw(some: np.ndarray) -> None:
        state[some] = _mix(state[some] + _U(0x9E3779B97F4A7C15))
        uniform = ((state[some] >> _U(11)).astype(float) + 0.5) / (1 << 53)
        time[some] -= np.log(uniform) / width[some]

    draw(np.arange(len(at)))
    until = PLACES * (np.log(PLACES) + 3) / np.maximum(total, 1)
    active = np.arange(len(at))
    while len(active):
        some = active[time[active] <= until[owner[active]]]
        while len(some):
            point = _mix(state[some] ^ _U(0xA0761D6478BD642F))
            place = owner[some] * PLACES + ((point >> _U(32)) % _U(PLACES)).astype(np.int64)
            kept = (_mix(point) >> _U(40)).astype(float) / (1 << 24) < seen[some]
            place, point, when = place[kept], point[kept], time[some][kept]
            np.minimum.at(best, place, when)
            first = best[place] == when
            values[place[first]] = point[first].astype(np.uint32)
            draw(some)
            some = some[time[some] <= until[owner[some]]]
        open_ = np.isinf(best.reshape(count, PLACES)).any(axis=1)
        active = active[open_[owner[active]]]
        until[open_] *= 1.5
    return values.reshape(count, PLACES)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags; that of two empty ones is 0."""
    common, at, bt = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = np.minimum(a[1][at], b[1][bt]).sum()
    union = a[1].sum() + b[1].sum() - least
    return float(least / union) if union else 0.0


def _key() -> Column:
    """A hash of ``doc_id`` and ``text``; a null is unlike any value."""
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    return F.xxhash64(doc_id.isNull(), doc_id, text.isNull(), text)


def _nodes(sketches: DataFrame) -> DataFrame:
    """``key, doc_id, digest, node`` of every row: rows of one id and the same words share a node.

    It is ``doc_id`` for one digest of each id, and a hash of both for the others and for null ids.
    """
    rows = sketches.select("key", "doc_id", "digest")
    one = rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("digest").alias("digest"))
    found = rows.join(one.withColumn("own", F.lit(True)), ["doc_id", "digest"], "left")
    other = F.xxhash64(F.col("doc_id").isNull(), "doc_id", "digest")
    node = F.when(F.col("own"), F.col("doc_id")).otherwise(other).alias("node")
    return write_out(found.select("key", "doc_id", "digest", node), "nodes")


_SKETCH = "key long, doc_id long, digest binary, n long, signature binary"


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the words, size of the bag and signature of every document."""
    for batch in batches:
        texts, start = batch.column("text"), 0
        bags, digests, waiting = [], [], 0
        for i, text in enumerate(texts):
            words = " ".join((text.as_py() or "").lower().split())
            digests.append(hashlib.md5(words.encode("utf-8", "surrogatepass")).digest())
            bags.append(bag_of(words))
            waiting += len(bags[-1][0])
            if waiting >= CHUNK or i + 1 == len(texts):
                signed = signatures(bags)
                part = batch.slice(start, len(bags))
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": part.column("key"),
                        "doc_id": part.column("doc_id"),
                        "digest": pa.array(digests, pa.binary()),
                        "n": pa.array([int(c.sum()) for _, c in bags], pa.int64()),
                        "signature": pa.array([s.tobytes() for s in signed], pa.binary()),
                    }
                )
                bags, digests, waiting, start = [], [], 0, i + 1


def _signature_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, PLACES)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document and band."""
    for batch in batches:
        signed = _signature_rows(batch.column("signature")).astype(_U)
        nodes = batch.column("node").to_numpy(zero_copy_only=False)
        for band in range(BANDS):
            key = np.full(len(nodes), band, _U)
            for i in range(ROWS):
                key = _mix(key * _U(0x9E3779B97F4A7C15) + signed[:, band * ROWS + i])
            bands = np.full(len(nodes), band, np.int32)
            yield pa.RecordBatch.from_pydict(
                {"bucket": key.view(np.int64), "band": bands, "node": nodes}
            )


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        same = _signature_rows(batch.column("sig_a")) == _signature_rows(batch.column("sig_b"))
        kept = batch.filter(pa.array(same.mean(axis=1) >= AGREE))
        yield kept.select(["a", "b"])


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose bags are similar enough; neighbouring rows often share their second text."""
    last, last_bag = None, None
    for batch in batches:
        kept = []
        for a, b, text in zip(*(batch.column(c) for c in ("text_a", "b", "text_b")), strict=True):
            if b.as_py() != last:
                last, last_bag = b.as_py(), bag_of(text.as_py())
            kept.append(similarity(bag_of(a.as_py()), last_bag) >= SIMILAR)
        yield batch.filter(pa.array(kept, pa.bool_())).select(["a", "b"])


def _verified(pairs: DataFrame, sketches: DataFrame, texts: DataFrame) -> DataFrame:
    """The ``pairs`` (``a, b``) of near duplicates: sizes, then signatures, then texts."""
    side = {s: sketches.selectExpr(f"node AS {s}", f"n AS n_{s}", f"signature AS sig_{s}") for s in "ab"}
    sized = pairs.join(side["a"], "a").join(side["b"], "b")
    sized = sized.where(f"least(n_a, n_b) >= {SIMILAR} * greatest(n_a, n_b)")
    likely = sized.select("a", "b", "sig_a", "sig_b").mapInArrow(_agreeing, "a long, b long")
    likely = write_out(likely, "likely-pairs")
    with_a = likely.join(texts.selectExpr("node AS a", "text AS text_a"), "a")
    with_b = with_a.join(texts.selectExpr("node AS b", "text AS text_b"), "b")
    found = with_b.select("a", "b", "text_a", "text_b").mapInArrow(_similar, "a long, b long")
    return write_out(found, "near-pairs")


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` of every node in ``edges`` (``a, b``) that has a link to another: the smallest
    node it is linked to.

    Links are contracted. In a round every node goes over to the first of itself and its neighbours;
    the links between what they went over to are the next round's, without loops and repeats. First is
    the smallest, which contracts stars in two rounds; from then on a hash decides in every other round,
    which halves a chain that is sorted along itself.
    """
    left = write_out(_links(edges.select("a", "b")), "links")
    steps: list[DataFrame] = []
    while not left.isEmpty():
        turn = len(steps)

        def rank(c: str, turn: int = turn) -> Column:
            return F.xxhash64(c, F.lit(turn)) if turn > 1 and turn % 2 == 0 else F.col(c)

        both = left.union(left.select("b", "a"))
        first = both.groupBy("a").agg(F.min(F.struct(rank("b").alias("rank"), F.col("b").alias("node"))).alias("near"))
        to = F.when(F.struct(rank("a"), "a") > F.col("near"), F.col("near.node")).otherwise(F.col("a"))
        steps.append(write_out(first.select(F.col("a").alias("node"), to.alias("to")), "contracted"))
        moved = left.join(steps[-1].toDF("a", "to_a"), "a").join(steps[-1].toDF("b", "to_b"), "b")
        left = write_out(_links(moved.select(F.col("to_a").alias("a"), F.col("to_b").alias("b"))), "links")
    if not steps:
        return left.toDF("node", "label")
    reached = steps[0]
    for step in steps[1:]:
        further = step.toDF("to", "next")
        reached = reached.join(further, "to", "left").select("node", F.coalesce("next", "to").alias("to"))
    reached = write_out(reached, "reached")
    smallest = reached.groupBy("to").agg(F.min("node").alias("label"))
    return write_out(reached.join(smallest, "to").select("node", "label"), "labels")


def _links(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The classes of ``labels``, put together where one of ``links`` (``a, b``) connects two.

    Only links between classes are contracted, each node standing for its class.
    """
    label_of = {s: labels.select(F.col("node").alias(s), F.col("label").alias(f"of_{s}")) for s in "ab"}
    between = links.join(label_of["a"], "a", "left").join(label_of["b"], "b", "left")
    between = between.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    merged = components(between)
    renamed = labels.join(merged.toDF("label", "merged"), "label", "left")
    known = renamed.select("node", F.coalesce("merged", "label").alias("label"))
    return write_out(known.union(merged.join(labels, "node", "left_anti").select("node", "label")), "labels")


def _stars(members: DataFrame, chosen: DataFrame) -> DataFrame:
    """Pairs of each member with the ``chosen`` one (``bucket, b``) of its bucket."""
    pairs = members.join(chosen, "bucket").where("node != b")
    pairs = pairs.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b"))
    return write_out(pairs.distinct(), "star-pairs")


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    found = members.join(labels, "node", "left")
    return found.withColumn("label", F.coalesce("label", "node"))


def _second_stars(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of another member of each bucket, its own one, with those of other classes.

    The first members are the same in most buckets of a group, which keeps the pairs of a large
    group few; what is too far from that one is mostly near to one of these.
    """
    rows = _labelled(members.select("bucket", "node"), labels)
    rows = write_out(rows.withColumn("turn", F.xxhash64("node", "bucket")), "labelled-members")
    own = rows.groupBy("bucket").agg(
        F.min_by(F.struct("node", "label"), "turn").alias("own"),
        (F.min("label") < F.max("label")).alias("open"),
    )
    own = own.where("open").select("bucket", F.col("own.node").alias("b"), F.col("own.label").alias("met"))
    left = rows.join(own, "bucket").where("label != met")
    pairs = left.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b"))
    return write_out(pairs.distinct(), "second-pairs")


def _in_blocks(key: tuple, rows: pa.Table) -> pa.Table:
    """Links between classes within a pair of blocks of a bucket, one for each class that joins.

    A pair that shares several buckets is compared in that of its first common band.
    """
    rows = rows.combine_chunks()
    signed = _signature_rows(rows.column("signature"))
    bands = signed.reshape(-1, BANDS, ROWS)
    band = key[1].as_py()
    node, n = rows.column("node").to_numpy(), rows.column("n").to_numpy()
    label, texts = rows.column("label").to_numpy().copy(), rows.column("text")
    bags: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def bag(i: int) -> tuple[np.ndarray, np.ndarray]:
        if i not in bags:
            bags[i] = bag_of(texts[i].as_py())
        return bags[i]

    a, b = [], []
    for i in range(len(node) - 1):
        j = np.arange(i + 1, len(node))
        j = j[(label[j] != label[i]) & (np.minimum(n[j], n[i]) >= SIMILAR * np.maximum(n[j], n[i]))]
        j = j[(signed[j] == signed[i]).mean(axis=1) >= AGREE]
        j = j[~(bands[j, :band] == bands[i, :band]).all(axis=2).any(axis=1)]
        for k in j.tolist():
            if label[k] != label[i] and similarity(bag(i), bag(k)) >= SIMILAR:
                a.append(min(node[i], node[k]))
                b.append(max(node[i], node[k]))
                label[label == label[k]] = label[i]
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _rest(
    members: DataFrame, labels: DataFrame, sketches: DataFrame, texts: DataFrame
) -> DataFrame:
    """Links that are left: in one bucket of three or more, between two classes."""
    labelled = _labelled(members, labels)
    open_ = (
        labelled.groupBy("bucket")
        .agg(F.count("*").alias("size"), F.min("label").alias("low"), F.max("label").alias("high"))
        .where("size > 2 AND low < high")
        .select("bucket", F.expr(f"int(ceil(size / {BLOCK}))").alias("blocks"))
    )
    rows = labelled.select("bucket", "band", "node", "label").join(open_, "bucket")
    rows = rows.withColumn("own", F.expr("int(pmod(xxhash64(node), blocks))"))
    rows = rows.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    rows = rows.select("bucket", "band", "node", "label", low.alias("i"), high.alias("j"))
    full = rows.join(sketches.select("node", "n", "signature"), "node").join(texts, "node")
    found = full.groupBy("bucket", "band", "i", "j").applyInArrow(_in_blocks, "a long, b long")
    return write_out(found.distinct(), "block-pairs")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, node, class_id`` of every row of ``docs``.

    Documents whose bags have a similarity of 0.8 or more are linked; a class is what links connect,
    and ``class_id`` its smallest ``node``. Rows with the same words in the same order are in one
    class, so are all without a word (null and empty texts). ``node`` is ``doc_id``, or a hash of the
    id and the words where the id is null or has other words too: only rows of one id and the same
    words are one document. Other columns are not read; an empty table gives no rows.
    """
    return _classes(docs).select("doc_id", "node", "class_id")


def _classes(docs: DataFrame) -> DataFrame:
    """:func:`near_duplicates` with the ``key`` of every row."""
    source = docs.select(
        _key().alias("key"), F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")
    )
    sketches = write_out(source.mapInArrow(_sketches, _SKETCH), "sketches")
    nodes = _nodes(sketches)
    copies = nodes.groupBy("digest").agg(F.min(F.struct("node", "key")).alias("one"))
    copies = write_out(copies.select("digest", "one.node", "one.key"), "copies")
    # rows that share a key are equal
    first = sketches.where("n > 0").join(copies.select("node", "key"), "key")
    first = first.groupBy("node", "key").agg(
        F.max("n").alias("n"), F.max("signature").alias("signature")
    )
    first = write_out(first, "first-copies")

    spread = first.select("node", "signature").mapInArrow(
        _buckets, "bucket long, band int, node long"
    )
    spread = spread.withColumn("turn", F.xxhash64("node"))
    shared = spread.groupBy("bucket").agg(F.count("*").alias("size"), F.min("turn").alias("first"))
    members = spread.join(shared.where("size > 1"), "bucket")
    members = write_out(members.select("bucket", "band", "node", "turn", "first"), "bucket-members")
    chosen = members.where("turn = first").select("bucket", F.col("node").alias("b"))
    suspects = first.select("node", "key").join(members.select("node").distinct(), "node")
    texts = source.select("key", "text").join(suspects, "key")
    texts = texts.groupBy("node").agg(F.max("text").alias("text"))
    texts = write_out(texts, "suspect-texts")

    near = _verified(_stars(members, chosen), first, texts)
    labels = components(near)
    more = _verified(_second_stars(members, labels), first, texts)
    if not more.isEmpty():
        labels = _joined(labels, more)
    rest = _rest(members, labels, first, texts)
    if not rest.isEmpty():
        labels = _joined(labels, rest)
    classes = copies.join(labels, "node", "left").select(
        "digest", F.coalesce("label", "node").alias("class_id")
    )
    return nodes.join(classes, "digest").select("key", "doc_id", "node", "class_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The row of each class of :func:`near_duplicates` whose ``node`` is the smallest.

    That is the smallest ``doc_id`` where no id is null or has several texts.
    """
    kept = _classes(docs).where("node = class_id").groupBy("node").agg(F.min("key").alias("key"))
    rows = packed(docs, key=_key()).join(kept.select("key"), "key").dropDuplicates(["key"])
    return unpacked(rows, docs.columns)
