"""Not-modified revisits resolved to the responses they stand for.

A revisit records that a server answered "304 Not Modified": it has validators and a few headers but
no payload. It stands for the latest earlier full response of the same canonical URL, if the
validators agree. The headers of the answer are those of the response, replaced by those that a 304
may carry.

The as-of join goes by slices of time: within a URL and slice by a window, across slices by the last
response of each slice. So a URL with a third of all captures is spread over ``SLICES`` tasks.
Payloads never move; the result names the response by its id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Headers that a 304 answer may update. Fixed values.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
SLICES = 64

RESPONSE, REVISIT = "response", "revisit"


def canonical_url(url: Column) -> Column:
    """Host in lower case without scheme, ``www.`` and default port; path without a closing slash;
    sorted query without ``utm_`` parameters; no fragment. Null for null."""
    whole = F.split_part(url, F.lit("#"), F.lit(1))
    place = F.regexp_replace(F.split_part(whole, F.lit("?"), F.lit(1)), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(place, "^[^/]*", 0)), "^www\\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(place, "/.*$", 0), "/+$", "")
    question = F.regexp_extract(whole, "\\?(.*)$", 1)
    kept = F.array_sort(F.filter(F.split(question, "&"), lambda p: (p != "") & ~p.startswith("utm_")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def _validators_agree(revisit_etag: Column, etag: Column, revisit_modified: Column, modified: Column) -> Column:
    """Entity tags by weak comparison; without both tags the dates; without either null."""
    def opaque(tag: Column) -> Column:
        return F.regexp_replace(tag, "^W/", "")

    return (
        F.when(revisit_etag.isNotNull() & etag.isNotNull(), opaque(revisit_etag) == opaque(etag))
        .when(revisit_modified.isNotNull() & modified.isNotNull(), revisit_modified == modified)
    )


def resolve_revisits(captures: DataFrame) -> DataFrame:
    """``(capture_id, url_key, status, response_id, headers)`` for each revisit.

    ``captures`` has ``capture_id, url, time`` (a whole number), ``kind`` (response or revisit), ``etag,
    last_modified`` and ``headers`` (a map with names in lower case); other columns are ignored, other
    kinds take no part. Status is ``resolved``, ``mismatch`` (the validators differ), ``unchecked``
    (there are none to compare) or ``missing`` (no earlier response, no URL or no time). Only resolved
    revisits have a response and headers. Earlier means a smaller time; of responses at one time the
    greatest id counts. Repeated revisits are each resolved.
    """
    rows = captures.select(
        "capture_id", canonical_url(F.col("url")).alias("url_key"), F.col("time").cast("bigint").alias("time"),
        "kind", "etag", "last_modified", F.coalesce("headers", F.create_map().cast("map<string,string>")).alias("headers"),
    ).filter(F.col("kind").isin(RESPONSE, REVISIT))
    first, last = rows.agg(F.min("time"), F.max("time")).first()
    width = (last - first) // SLICES + 1 if first is not None else 1
    response = F.when(
        (F.col("kind") == RESPONSE) & F.col("time").isNotNull(),
        F.struct("time", F.col("capture_id").alias("id"), "etag", "last_modified",
                 F.array_sort(F.map_entries("headers")).alias("headers")))
    placed = (
        rows.withColumn("slice", F.floor((F.col("time") - F.lit(first or 0)) / width))
        .withColumn("response", response)
    )
    inside = Window.partitionBy("url_key", "slice").orderBy("time").rangeBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("url_key").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        placed.groupBy("url_key", "slice").agg(F.max("response").alias("newest"))
        .withColumn("carried", F.max("newest").over(before)).select("url_key", "slice", "carried")
    )
    revisits = placed.withColumn("near", F.max("response").over(inside)).filter(F.col("kind") == REVISIT)
    found = F.coalesce("near", "carried")
    agrees = _validators_agree(F.col("etag"), F.col("found.etag"), F.col("last_modified"), F.col("found.last_modified"))
    permitted = F.map_filter("headers", lambda name, _: name.isin(*PERMITTED))
    kept = F.map_filter(
        F.map_from_entries("found.headers"), lambda name, _: ~F.array_contains(F.map_keys(permitted), name))
    resolved = F.col("status") == "resolved"
    known = F.col("url_key").isNotNull() & F.col("time").isNotNull()
    return (
        revisits.join(carried, ["url_key", "slice"], "left").withColumn("found", F.when(known, found))
        .withColumn("status", F.when(F.col("found").isNull(), "missing").when(agrees, "resolved")
                    .when(~agrees, "mismatch").otherwise("unchecked"))
        .select(
            "capture_id", "url_key", "status", F.when(resolved, F.col("found.id")).alias("response_id"),
            F.when(resolved, F.map_concat(kept, permitted)).alias("headers"))
    )


def header_lines(headers: Column) -> Column:
    """A header map as text, by name."""
    return F.array_join(
        F.transform(F.array_sort(F.map_entries(headers)), lambda h: F.concat(h["key"], F.lit(": "), h["value"])), "\n")


def captures_of_pages(pages: DataFrame) -> DataFrame:
    """Captures that a crawl of ``pages (page_id, url, html)`` would have recorded.

    Each page is fetched once (those with an id divisible by 11 by someone else, so no response is
    there) and asked for again later. Every seventh page has changed its tag by then, and every fifth
    server knows dates only.
    """
    page = F.col("page_id")
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    dated = F.concat(F.lit("day "), (page % 97).cast("string"))
    by_date = page % 5 == 0
    shared = pages.select(
        page.alias("page_id"), "url", F.when(~by_date, tag).alias("etag"), dated.alias("last_modified"))

    def headers(**values: Column | str) -> Column:
        pairs = [x for k, v in values.items()
                 for x in (F.lit(k.replace("_", "-")), v if isinstance(v, Column) else F.lit(v))]
        return F.map_filter(F.create_map(*pairs), lambda _, value: value.isNotNull())

    def second(time: Column) -> Column:
        return F.concat(F.lit("second "), time.cast("string"))

    asked = page * 3 + 200_000
    responses = shared.filter(page % 11 != 0).select(
        (page * 2).alias("capture_id"), "url", (page * 3).alias("time"), F.lit(RESPONSE).alias("kind"),
        "etag", "last_modified",
        headers(content_type="text/html", server="origin", date=second(page * 3), etag=F.col("etag"),
                last_modified=F.col("last_modified")).alias("headers"))
    changed = F.when(by_date, F.lit(None)).when(page % 7 == 0, '"changed"').otherwise(F.concat(F.lit("W/"), "etag"))
    revisits = shared.select(
        (page * 2 + 1).alias("capture_id"), "url", asked.alias("time"), F.lit(REVISIT).alias("kind"),
        changed.alias("etag"), F.when(page % 7 == 0, "never").otherwise(F.col("last_modified")).alias("last_modified"),
        headers(server="edge", content_length="0", date=second(asked),
                cache_control=F.concat(F.lit("max-age="), (page % 60).cast("string"))).alias("headers"))
    return responses.union(revisits)


#: The same in DuckDB SQL, for the query over ``pages``.
PAGES_SQL = r"""
WITH parts AS (
    SELECT page_id, html, split_part(url, '#', 1) AS whole FROM pages WHERE page_id IS NOT NULL
), places AS (
    SELECT page_id, html, whole,
           regexp_replace(split_part(whole, '?', 1), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS place,
           list_sort(list_filter(string_split(regexp_extract(whole, '\?(.*)$', 1), '&'),
                                 lambda p: p <> '' AND NOT starts_with(p, 'utm_'))) AS params
    FROM parts
), keyed AS (
    SELECT page_id, html,
           regexp_replace(lower(regexp_extract(place, '^[^/]*')), '^www\.|:(80|443)$', '', 'g')
           || regexp_replace(regexp_extract(place, '/.*$'), '/+$', '')
           || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS url_key
    FROM places
), responses AS (
    SELECT page_id, url_key, page_id * 3 AS time, '"' || md5(coalesce(html, '')) || '"' AS tag
    FROM keyed WHERE page_id % 11 <> 0
), revisits AS (
    SELECT page_id, url_key, page_id * 3 + 200000 AS time, '"' || md5(coalesce(html, '')) || '"' AS tag FROM keyed
), joined AS (
    SELECT v.page_id, v.url_key, v.time, r.page_id AS found,
           CASE WHEN r.page_id IS NULL THEN 'missing'
                WHEN CASE WHEN v.page_id % 5 <> 0 AND r.page_id % 5 <> 0
                          THEN v.page_id % 7 <> 0 AND v.tag = r.tag
                          ELSE v.page_id % 7 <> 0 AND v.page_id % 97 = r.page_id % 97 END THEN 'resolved'
                ELSE 'mismatch' END AS status,
           r.tag, r.time AS response_time
    FROM revisits v ASOF LEFT JOIN responses r ON v.url_key = r.url_key AND v.time > r.time
)
SELECT page_id * 2 + 1 AS capture_id, url_key, status,
       CASE WHEN status = 'resolved' THEN found * 2 END AS response_id,
       CASE WHEN status = 'resolved' THEN
            'cache-control: max-age=' || (page_id % 60) || chr(10) || 'content-type: text/html' || chr(10)
            || 'date: second ' || time || chr(10)
            || CASE WHEN found % 5 <> 0 THEN 'etag: ' || tag || chr(10) ELSE '' END
            || 'last-modified: day ' || (found % 97) || chr(10) || 'server: origin' END AS header_lines
FROM joined
"""
