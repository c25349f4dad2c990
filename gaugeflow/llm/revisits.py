"""Not-modified revisits of a web archive, resolved to the responses they refer to.

A revisit says that a page had not changed since it was fetched in full. It is joined as of its time
to the latest earlier full response of the same canonical URL. If the validators agree it becomes a
response again: with that one's body and headers, updated by those that a not-modified answer may
change.

One URL may have any share of the records. Times are put into blocks: within a block a window finds
the latest response, and the latest one of earlier blocks comes from a row per URL and block. Records
of one URL and second are merged before, so no window sees more than ``block_seconds`` rows in the
first step, and in the second no more than the archive has blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Headers that a not-modified answer doesn't change in the stored response.
KEPT_HEADERS = (
    "connection content-encoding content-length content-range content-type keep-alive "
    "proxy-authenticate proxy-authorization proxy-connection te trailer transfer-encoding upgrade"
).split()
#: Parameters that don't name another page.
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"

RECORD = (
    "record_id string, url string, ts long, kind string, headers map<string,string>, body string"
)


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and default port, path, sorted query without tracking."""
    form = r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)([^?#]*)(?:\?([^#]*))?"
    host = F.lower(F.regexp_extract(url, form, 1))
    host = F.regexp_replace(F.regexp_replace(host, r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(F.regexp_extract(url, form, 2), r"/+$", "")
    asked = F.split(F.regexp_extract(url, form, 3), "&")
    asked = F.array_sort(F.filter(asked, lambda p: (p != "") & ~p.rlike(TRACKING)))
    query = F.when(F.size(asked) > 0, F.concat(F.lit("?"), F.array_join(asked, "&")))
    return F.concat(host, path, F.coalesce(query, F.lit("")))


def _headers(headers: str) -> Column:
    """Headers with names in lower case; of names that then agree the last one counts."""
    return F.expr(f"""coalesce(transform(
        array(transform(map_entries({headers}), e -> struct(lower(e.key) AS key, e.value AS value))),
        es -> map_from_entries(filter(es, (e, i) -> NOT exists(
            slice(es, i + 2, size(es)), later -> later.key = e.key))))[0],
        cast(map() AS map<string,string>))""")


def _validated() -> Column:
    """Whether the revisit's validators ``new`` agree with the stored ``old`` ones."""
    weak = F.expr("regexp_replace(new['etag'], '^W/', '') = regexp_replace(old['etag'], '^W/', '')")
    agree = (
        F.when(F.expr("new['etag'] LIKE 'W/%'"), weak)
        .when(F.expr("new['etag'] IS NOT NULL"), F.expr("new['etag'] = old['etag']"))
        .when(
            F.expr("new['last-modified'] IS NOT NULL"),
            F.expr("new['last-modified'] = old['last-modified']"),
        )
        .otherwise(F.expr("old['etag'] IS NULL AND old['last-modified'] IS NULL"))
    )
    return F.coalesce(agree, F.lit(False))


def resolve_revisits(records: DataFrame, block_seconds: int = 3600) -> DataFrame:
    """One row per ``revisit`` of ``records`` (columns of :data:`RECORD`).

    ``record_id, url, canonical, ts, outcome, refers_to, refers_ts, headers``. ``outcome`` is
    ``resolved``, ``changed`` (the validators differ; an entity tag counts before a date, and where
    the revisit has neither the response must have neither) or ``no_response``; the last three
    columns are those of the response found, ``headers`` merged if resolved and else the revisit's.
    Of several responses in one second the largest ``record_id`` counts. A null url or time has no
    response; repeated revisits stay repeated; other columns are not read. Without revisits, or records,
    there are no rows.
    """
    source = records.select(
        "record_id", "url", canonical_url(F.col("url")).alias("canonical"), "ts", "kind",
        _headers("headers").alias("headers"),
    )
    revisits = source.where("kind = 'revisit'").drop("kind")
    responses = source.where("kind = 'response' AND record_id IS NOT NULL")
    responses = responses.groupBy("canonical", "ts").agg(
        F.max("record_id").alias("refers_to"), F.max_by("headers", "record_id").alias("old")
    )
    moments = (
        responses.select("canonical", "ts", F.col("ts").alias("at"))
        .unionByName(revisits.select("canonical", "ts").distinct(), allowMissingColumns=True)
        .groupBy("canonical", "ts")
        .agg(F.max("at").alias("at"))
        .withColumn("block", F.expr(f"ts div {block_seconds}"))
    )
    earlier = (Window.unboundedPreceding, -1)
    in_block = Window.partitionBy("canonical", "block").orderBy("ts").rowsBetween(*earlier)
    of_url = Window.partitionBy("canonical").orderBy("block").rowsBetween(*earlier)
    blocks = moments.groupBy("canonical", "block").agg(F.max("at").alias("at"))
    blocks = blocks.select("canonical", "block", F.max("at").over(of_url).alias("before"))
    moments = moments.withColumn("near", F.max("at").over(in_block))
    latest = moments.join(blocks, ["canonical", "block"]).select(
        "canonical", "ts", F.coalesce("near", "before").alias("refers_ts")
    )
    found = revisits.join(latest, ["canonical", "ts"], "left").join(
        responses.withColumnRenamed("ts", "refers_ts"), ["canonical", "refers_ts"], "left"
    )
    found = found.withColumnRenamed("headers", "new")
    outcome = F.when(F.col("refers_to").isNull(), "no_response")
    found = found.withColumn("outcome", outcome.when(_validated(), "resolved").otherwise("changed"))
    kept = ", ".join(f"'{name}'" for name in KEPT_HEADERS)
    merged = F.expr(f"""map_concat(
        map_filter(old, (k, v) -> k IN ({kept}) OR NOT map_contains_key(new, k)),
        map_filter(new, (k, v) -> k NOT IN ({kept})))""")
    headers = F.when(F.col("outcome") == "resolved", merged).otherwise(F.col("new"))
    return found.select(
        "record_id", "url", "canonical", "ts", "outcome", "refers_to", "refers_ts",
        headers.alias("headers"),
    )


def with_bodies(resolved: DataFrame, records: DataFrame) -> DataFrame:
    """Rows of :func:`resolve_revisits` with the ``body`` of the response, if resolved."""
    bodies = records.where("kind = 'response'").groupBy(F.col("record_id").alias("refers_to"))
    rows = resolved.join(bodies.agg(F.max("body").alias("body")), "refers_to", "left")
    return rows.withColumn("body", F.when(F.col("outcome") == "resolved", F.col("body")))
