"""Secrets in texts: fixed patterns, and random strings by two character Markov models.

One model learns which character follows which in random strings, the other in ordinary identifiers;
a run of characters whose mean log-likelihood ratio passes a threshold is a secret. Scanning, training
and scoring are DataFrame expressions; the trained pair is one constant table of log ratios.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.arrays import once, packed, unpacked
from gaugeflow.session import write_out

#: Kinds, patterns, what a match must fulfil to count, and what a text must have for
#: the pattern to be tried. Quotes are written as \x22 and \x27.
_ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?"
    r"([A-Za-z0-9+/_.=-]+)"
)
BASE = (
    (
        "assign",
        _ASSIGN,
        rf"length(regexp_extract(m, r'{_ASSIGN}', 2)) >= 12",
        r"text RLIKE r'(?i:password|passwd|secret|token|api_?key)[\x22\x27]?\x20*[:=]'",
    ),
    ("access", r"AKIA[A-Z0-9]+", "length(m) >= 18", "contains(text, 'AKIA')"),
    ("hex", r"[0-9a-f]{16,}", "true", "text RLIKE r'[0-9a-f]{16}'"),
)
#: Runs of characters that the models judge.
RUN, RUN_FOUND = r"[A-Za-z0-9+/_=-]{20,}", r"text RLIKE r'[A-Za-z0-9+/_=-]{20}'"
#: Characters of the shortest run, and of the shortest piece of one that is judged.
SHORTEST = 20
KINDS = (*(kind for kind, *_ in BASE), "markov")

#: Characters of a run lie between these codes.
_LOW, _CODES = ord("+"), ord("z") - ord("+") + 1

_SPANS = "array<struct<start:int,kind:int,end:int>>"


@dataclass(frozen=True)
class MarkovPair:
    """Log ratio, random against ordinary, of every pair of characters; the mean that suffices."""

    ratios: tuple[float, ...]
    threshold: float


def train(samples: DataFrame, threshold: float = 0.5) -> MarkovPair:
    """Two models of which character follows which, from ``text, random`` (boolean) rows.

    Null texts and labels teach nothing. Counts start at a half, so an unseen pair has a finite
    ratio, and without any samples all ratios are 0: nothing is random then.
    """
    pairs = F.expr("transform(sequence(1, length(text) - 1), i -> substring(text, i, 2))")
    counts = (
        samples.where("length(text) >= 2 AND random IS NOT NULL")
        .select("random", F.explode(pairs).alias("pair"))
        .where(F.col("pair").rlike(r"^[A-Za-z0-9+/_=-]{2}$"))
        .groupBy("random", "pair")
        .agg(F.count("*").alias("n"))
        .collect()  # two rows per pair of 66 characters at most
    )
    tables = {True: [0.5] * _CODES**2, False: [0.5] * _CODES**2}
    for row in counts:
        a, b = (ord(c) - _LOW for c in row["pair"])
        tables[row["random"]][a * _CODES + b] += row["n"]
    ratios = []
    for a in range(_CODES):
        of = slice(a * _CODES, (a + 1) * _CODES)
        random, ordinary = sum(tables[True][of]), sum(tables[False][of])
        ratios += [
            round(math.log(x / random) - math.log(y / ordinary), 4)
            for x, y in zip(tables[True][of], tables[False][of], strict=True)
        ]
    return MarkovPair(tuple(ratios), threshold)


def labelled_samples(docs: DataFrame, bound: int = 4000) -> DataFrame:
    """``text, random`` rows from about ``bound`` of the documents, all if there are fewer.

    Ordinary: their words, and identifiers put together from three neighbouring words. Random:
    digests of their ids and texts in base 64 and in hexadecimal digits of either case, and the secrets that the
    fixed patterns find in them.
    """
    total = max(docs.count(), 1)
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    share = int(min(1.0, bound / total) * 1_000_000)
    texts = texts.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < share)
    texts = write_out(texts, "secret-samples")  # four branches read it
    digest = F.sha2(F.concat_ws(" ", F.col("doc_id").cast("string"), "text"), 256)
    random = texts.select(
        F.explode(F.array(digest, F.upper(digest), F.base64(F.unhex(digest)))).alias("text")
    ).union(texts.select(F.explode(F.expr(_matched_texts())).alias("text")))
    words = once(texts, words=F.expr(r"regexp_extract_all(text, r'[A-Za-z]{2,}', 0)"))
    triples = """transform(sequence(1, greatest(size(words) div 3, 1)),
        i -> concat_ws('_', slice(words, 3 * i - 2, 3)))"""
    camel = """transform(sequence(1, greatest(size(words) div 3, 1)),
        i -> concat_ws('', transform(slice(words, 3 * i - 2, 3), w -> initcap(w))))"""
    ordinary = words.select(F.explode(F.expr(f"concat(words, {triples}, {camel})")).alias("text"))
    return random.withColumn("random", F.lit(True)).union(
        ordinary.withColumn("random", F.lit(False))
    )


def _matched_texts() -> str:
    found = [
        f"""CASE WHEN {first} THEN filter(regexp_extract_all(text, r'{pattern}', 0), m -> {keep})
            ELSE cast(array() AS array<string>) END"""
        for _, pattern, keep, first in BASE
    ]
    return f"concat({', '.join(found)})"


def _spans(kind: int, pattern: str, keep: str, first: str) -> str:
    """SQL of the spans of a pattern: what lies between its matches tells where they are."""
    none = f"cast(array() AS {_SPANS})"
    return f"""CASE WHEN {first} THEN aggregate(
        zip_with(split(text, r'{pattern}', -1), regexp_extract_all(text, r'{pattern}', 0),
                 (p, m) -> named_struct('p', length(p), 'n', length(m), 'keep', {keep})),
        named_struct('at', 0, 'found', {none}),
        (s, x) -> named_struct(
          'at', s.at + x.p + coalesce(x.n, 0),
          'found', CASE WHEN x.n IS NOT NULL AND x.keep THEN concat(s.found, array(named_struct(
              'start', s.at + x.p, 'kind', {kind}, 'end', s.at + x.p + x.n))) ELSE s.found END),
        s -> s.found) ELSE {none} END"""


def _score(model: MarkovPair) -> str:
    """SQL: whether the run ``m`` is random."""
    table = f"cast(split('{','.join(map(str, model.ratios))}', ',') AS array<double>)"
    pair = f"{table}[(ascii(substring(m, i, 1)) - {_LOW}) * {_CODES}"
    pair += f" + ascii(substring(m, i + 1, 1)) - {_LOW}]"
    total = f"aggregate(transform(sequence(1, length(m) - 1), i -> {pair}), 0D, (s, r) -> s + r)"
    return f"{total} > {model.threshold} * (length(m) - 1)"


def _pieces(run: str) -> str:
    """SQL: what the base spans leave of a run, in pieces that are long enough to be judged."""

    def found(end: str) -> str:
        piece = f"named_struct('start', a.at, 'kind', {run}.kind, 'end', {end})"
        long_enough = f"{end} - a.at >= {SHORTEST}"
        return f"CASE WHEN {long_enough} THEN concat(a.found, array({piece})) ELSE a.found END"

    return f"""aggregate(
        filter(base_spans, b -> b.start < {run}.end AND {run}.start < b.end),
        named_struct('at', {run}.start, 'found', cast(array() AS {_SPANS})),
        (a, b) -> named_struct('at', greatest(a.at, b.end), 'found', {found("b.start")}),
        a -> {found(f"{run}.end")})"""


def find_secrets(docs: DataFrame, model: MarkovPair) -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans``: ``start, kind, end`` in characters, by start.

    ``kind`` is an index of :data:`KINDS`. Spans of the models do not overlap those of the patterns:
    what these leave of a run is judged piece by piece. A null or empty text has no spans. Other columns
    stay, whatever their names; only columns of these two names are replaced. Rows are neither merged
    nor dropped, and an empty table gives an empty one.
    """
    names = [c for c in docs.columns if c not in ("base_spans", "spans")]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = packed(docs.select(*[F.col(f"`{c}`") for c in names]), text=text)
    base = ", ".join(_spans(k, *rest) for k, (_, *rest) in enumerate(BASE))
    runs = _spans(len(BASE), RUN, "true", RUN_FOUND)
    found = once(
        once(rows, text=F.col("text")), base_spans=F.expr(f"array_sort(concat({base}))"), runs=F.expr(runs)
    )
    found = once(found, pieces=F.expr(f"flatten(transform(runs, r -> {_pieces('r')}))"))
    random = f"""filter(pieces, x -> exists(
        array(substring(text, x.start + 1, x.end - x.start)), m -> {_score(model)}))"""
    found = found.withColumn("spans", F.expr(f"array_sort(concat(base_spans, {random}))"))
    spans = {"base_spans": F.col("base_spans"), "spans": F.col("spans")}
    return unpacked(found, [*names, *spans], **spans)


def spans_text(spans: str) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    kinds = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(
        f"concat_ws(',', transform({spans}, x -> "
        f"concat_ws(':', array({kinds})[x.kind], x.start, x.end)))"
    )


def redact(found: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """Rows of :func:`find_secrets` with every span of ``text`` replaced by ``mark``.

    Overlapping spans are replaced together; a text without spans, null included, stays as it is.
    """
    new = F.expr(f"""CASE WHEN size(spans) = 0 THEN text ELSE aggregate(
        spans, named_struct('at', 0, 'out', ''),
        (s, x) -> named_struct(
          'at', greatest(s.at, x.end),
          'out', CASE WHEN x.start >= s.at
            THEN concat(s.out, substring(text, s.at + 1, x.start - s.at), '{mark}')
            ELSE s.out END),
        s -> concat(s.out, substring(text, s.at + 1))) END""")
    rows = once(packed(found, text=F.col("text"), spans=F.col("spans")), new=new)
    return unpacked(rows, found.columns, text=F.col("new"))
