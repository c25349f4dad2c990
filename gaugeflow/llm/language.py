"""Language of texts by Bloom filters of character n-grams, sliced by language.

One table serves all languages: each slot holds a bit mask with one bit per language. An n-gram sets
its languages' bits in a few slots; the masks of its slots, and-ed, give all languages that contain
it at once. A text's hits are counted per language, less the false ones that the language's filter is
expected to give, and the language with most decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugeflow.llm.arrays import packed, unpacked
from gaugeflow.session import write_out

#: Characters of an n-gram; non-letters count as spaces.
SIZES = (2, 3, 4)
#: Slots of the table, as a power of two, and slots per n-gram.
SLOT_BITS, HASHES = 20, 3
#: Languages that one table can hold.
MOST_LANGUAGES = 64
#: Characters that are handled at once.
CHUNK = 1 << 20
UNKNOWN = "und"

_SPACE = 32


@cache
def _is_letter() -> np.ndarray:
    """By code point."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def _codes(text: str) -> np.ndarray:
    """Code points of the lower-cased text, non-letters as spaces."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(_is_letter()[codes], codes, _SPACE).astype(np.uint64)


def _grams(codes: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of the n-grams at every place; the last places have none."""
    count = max(len(codes) - size + 1, 0)
    h = np.full(count, size, np.uint64)
    for i in range(size):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += codes[i : i + count]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _slots(h: np.ndarray) -> Iterator[np.ndarray]:
    for k in range(HASHES):
        yield (h >> np.uint64(k * SLOT_BITS)) & np.uint64((1 << SLOT_BITS) - 1)


@dataclass(frozen=True)
class LanguageFilters:
    """The languages, most frequent first, the table of masks, and expected false hits per n-gram."""

    languages: tuple[str, ...]
    table: np.ndarray
    false_rate: np.ndarray

    def hits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per text: corrected hits by language, and how many n-grams lie at a letter."""
        joined = "".join([f" {t} " for t in texts])
        codes = _codes(joined)
        if len(joined) == len(codes):
            ends = np.cumsum([len(t) + 2 for t in texts])
        else:  # lower-casing a few letters gives two
            ends = np.cumsum([len(t.lower()) + 2 for t in texts])
        starts = np.r_[0, ends[:-1]].astype(np.int64)
        found = np.zeros((len(texts), len(self.languages)))
        asked = np.zeros(len(texts))
        for size in SIZES:
            h = _grams(codes, size)
            mask = self.table[next(slots := _slots(h))]
            for at in slots:
                mask &= self.table[at]
            real = codes[: len(h)] != _SPACE
            asked += np.add.reduceat(np.r_[real, np.zeros(len(codes) - len(h))], starts)
            mask[~real] = 0
            mask = np.r_[mask, np.zeros(len(codes) - len(h), mask.dtype)]
            for k in range(len(self.languages)):
                bit = (mask >> mask.dtype.type(k)) & mask.dtype.type(1)
                found[:, k] += np.add.reduceat(bit, starts, dtype=np.int64)
        found = (found - asked[:, None] * self.false_rate) / (1 - self.false_rate)
        return np.maximum(found, 0), asked


def _lookup(values: dict[str, int]) -> Column:
    """``values`` as a map in SQL."""
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair]).cast("map<string, bigint>")


def _chunks(texts: list[str]) -> Iterator[list[str]]:
    chunk, size = [], 0
    for text in texts:
        chunk.append(text)
        size += len(text)
        if size >= CHUNK:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def train(
    docs: DataFrame, bound: int = 8_000, most: int = 40_000, rare: float = 0.002, near: float = 0.2
) -> LanguageFilters:
    """Filters learned from ``text`` and ``lang``, from about ``bound`` rows of each language.

    They are chosen by a hash of the text, and equal texts of a language teach once; a language with
    fewer rows is learned from all of them.

    A language contains an n-gram if a share of at least ``rare`` of its texts has it and that share
    is at least ``near`` times the largest of any language; of these the ``most`` frequent. Rows
    without text or language teach nothing, other columns are not read, and an empty table gives
    filters without a language. More than 64 languages are refused.
    """
    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL").select(
        F.col("text").cast("string"), F.col("lang").cast("string")
    )
    # at most MOST_LANGUAGES + 1 rows
    n_rows = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(n_rows) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    share = _lookup({lang: min(1_000_000, bound * 1_000_000 // n) for lang, n in n_rows.items()})
    hashed = rows.withColumn("h", F.xxhash64("text"))
    some = hashed.where(F.pmod("h", F.lit(1_000_000)) < share[F.col("lang")])
    rows = write_out(some.groupBy("lang", "h").agg(F.max("text").alias("text")).select("text", "lang"), "language-sample")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        waiting = 0

        def out() -> pa.RecordBatch:
            langs, grams, ns = [], [], []
            for lang, parts in held.items():
                gram, n = np.unique(np.concatenate(parts), return_counts=True)
                langs += [lang] * len(gram)
                grams.append(gram.view(np.int64))
                ns.append(n)
            return pa.RecordBatch.from_pydict(
                {"lang": langs, "gram": np.concatenate(grams), "n": np.concatenate(ns)}
            )

        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                codes = _codes(f" {text.as_py()} ")
                for size in SIZES:
                    h = _grams(codes, size)
                    held.setdefault(lang, []).append(np.unique(h[codes[: len(h)] != _SPACE]))
                    waiting += len(held[lang][-1])
                if waiting > 5_000_000:
                    yield out()
                    held, waiting = {}, 0
        if held:
            yield out()

    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang")
    n_docs = {r["lang"]: r["count"] for r in sizes.collect()}  # MOST_LANGUAGES at most
    languages = tuple(n_docs)
    kind = np.uint8 if len(languages) <= 8 else np.uint64
    table = np.zeros(1 << SLOT_BITS, kind)
    if languages:
        grams = rows.mapInArrow(counted, "lang string, gram long, n long")
        grams = grams.groupBy("gram", "lang").agg(F.sum("n").alias("n"))
        grams = grams.withColumn("rate", F.col("n") / _lookup(n_docs)[F.col("lang")])
        largest = grams.groupBy("gram").agg(
            F.max("rate").alias("top"), F.collect_list(F.struct("lang", "rate")).alias("each")
        )
        kept = largest.select("gram", "top", F.inline("each")).where(
            (F.col("rate") >= rare) & (F.col("rate") >= near * F.col("top"))
        )
        first = Window.partitionBy("lang").orderBy(F.desc("rate"), "gram")
        best = kept.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= most)
        best = best.groupBy("lang").agg(F.collect_list("gram").alias("grams"))
        for r in best.collect():  # ``most`` n-grams of each language
            h = np.array(r["grams"], np.int64).view(np.uint64)
            for at in _slots(h):
                table[at] |= kind(1 << languages.index(r["lang"]))
    filled = [np.mean((table >> kind(k)) & kind(1)) for k in range(len(languages))]
    return LanguageFilters(languages, table, np.array(filled) ** HASHES)


def predict(docs: DataFrame, filters: LanguageFilters) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``support``.

    ``score`` weighs the hits of the language predicted against those of the next one, from 0 to 1;
    ``support`` is the share of the n-grams that the language contains. Texts that are null or have
    no letter are ``und`` with score 0, as are all where nothing was learned; ties go to the language
    that was more frequent. Other columns stay; such as clash with the three are replaced. Every row is
    judged by itself, repeated ones too, and an empty table gives an empty one.
    """
    found = {c: F.col(c) for c in ("lang_pred", "score", "support")}
    names = [c for c in docs.columns if c not in found]
    return unpacked(judged(docs, filters), [*names, *found], **found)


def judged(docs: DataFrame, filters: LanguageFilters) -> DataFrame:
    """What :func:`predict` finds, beside each whole row of ``docs`` as the struct ``row``."""
    rows = packed(docs)
    model = docs.sparkSession.sparkContext.broadcast(filters)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = model.value.languages
        for batch in batches:
            texts = [t or "" for t in batch.column(0).field("text").to_pylist()]
            langs, scores, supports = [], [], []
            for chunk in _chunks(texts) if names else []:
                hits, asked = model.value.hits(chunk)
                order = np.argsort(-hits, axis=1, kind="stable")
                one = np.arange(len(chunk))
                best = hits[one, order[:, 0]]
                second = hits[one, order[:, 1]] if len(names) > 1 else np.zeros(len(chunk))
                scores += np.divide(best, best + second, where=best > 0, out=0 * best).tolist()
                supports += (best / np.maximum(asked, 1)).clip(0, 1).tolist()
                langs += [
                    names[k] if n > 0 else UNKNOWN
                    for k, n in zip(order[:, 0].tolist(), asked.tolist(), strict=True)
                ]
            none = len(texts) - len(langs)
            found = {
                "lang_pred": pa.array(langs + [UNKNOWN] * none),
                "score": pa.array(scores + [0.0] * none, pa.float64()),
                "support": pa.array(supports + [0.0] * none, pa.float64()),
            }
            for name, column in found.items():
                batch = batch.append_column(name, column)
            yield batch

    schema = StructType(list(rows.schema.fields))
    schema = schema.add("lang_pred", "string").add("score", "double").add("support", "double")
    return rows.mapInArrow(judge, schema)
