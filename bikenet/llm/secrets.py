"""Secrets in texts: three plain kinds, and strings that pass as random.

Everything is a DataFrame expression; no Python runs in tasks.

**Base kinds** are found by their patterns, leftmost and without overlap within a kind; matches
that are too short are dropped afterwards.

**Random strings** are runs of twenty or more characters of an encoding. What base spans cover is
cut out of a run, and each remaining piece of that length is tested; so are its parts between ``/``,
``_`` and ``-``, since words in front of a token would dilute it. The encoding is
inferred (decimal, hexadecimal, base 32, else base 64), and under the hypothesis that the characters
are independent and uniform over its alphabet these tests give a p-value each:

* chi-squared uniformity of the alphabet (too few different characters count against a string, too
  many do not), standardised by its exact mean and variance at that length, and the same over the
  quarters of the alphabet, where one case of letters alone shows;
* Wald-Wolfowitz runs above and below the middle of the alphabet;
* serial correlation of neighbouring characters.

The least, times four, is the string's p-value. Long strings tell words from noise better than
short ones, so the Benjamini-Hochberg procedure is applied within bands of length over the whole
corpus: randomness is rejected so that at most ``FALSE_SHARE`` of the rejected strings are expected
to be random. What is not rejected is reported as ``random``, a part only if its piece is not. The procedure needs only a histogram
of p-values, a few hundred rows a band.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Base kinds in the order of the listing: pattern, group whose length counts, least length.
BASE = {
    "assign": (
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
#: Shorter hexadecimal runs would be dropped, so the search passes over them at once.
_HEX_SEARCH = r"[0-9a-f]{24,}"
#: Maximal runs, tried only where one begins.
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"
LEAST_RUN = 20
#: Parts of a run between the signs that also separate words.
PART = r"[A-Za-z0-9+]{20,}={0,2}"
RANDOM = "random"
KINDS = (*BASE, RANDOM)

_DIGITS = "0123456789"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = {
    "decimal": _DIGITS,
    "hexadecimal": _DIGITS + "abcdef",
    "base32": _CAPITALS + "234567",
    "base64": _CAPITALS + _CAPITALS.lower() + _DIGITS + "+/",
}

FALSE_SHARE = 0.05
#: Lengths at which a band begins.
BANDS = (20, 24, 32, 48, 64, 128)
#: Steps of a power of ten in the histogram of p-values, and its last bin.
STEPS, LAST_BIN = 20, 400


def _bound(value: Column, made: Callable[[Column], Column]) -> Column:
    """``made(value)`` with the value worked out once, however often it is used."""
    return F.transform(F.array(value), made)[0]


def _chunks(array: Column) -> Column:
    """An array cut into about as many arrays as each of them has elements; at least one, maybe empty.

    What has to look at all elements, or to copy what it has so far, does so for each chunk alone.
    So n matches of a text take some n times the root of n steps instead of n times n.
    """
    def cut(a: Column) -> Column:
        return _bound(F.greatest(F.ceil(F.sqrt(F.size(a))), F.lit(1)).cast("int"), lambda k: F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(a) - 1, F.lit(0)), k), lambda at: F.slice(a, at + 1, k)))

    return _bound(array, cut)


def _before(values: Column, first: Column, add: Callable[[Column, Column], Column]) -> Column:
    """For each value of a short array what ``add`` makes of all that stand before it."""
    return F.aggregate(
        values, F.struct(first.alias("at"), F.expr("cast(array() as array<int>)").alias("out")),
        lambda s, v: F.struct(add(s["at"], v).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")),
        lambda s: s["out"])


def _found(text: Column, pattern: str, group: int, least: int) -> Column:
    """array<struct<start, end, value>> of the matches, in code points.

    The pieces between the matches give their places.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    counted = matches if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    pieces = F.split(text, pattern, -1)
    placed = F.zip_with(
        F.zip_with(matches, F.slice(pieces, 1, F.size(matches)),
                   lambda m, p: F.struct(m.alias("value"), F.length(p).alias("before"))),
        counted,
        lambda m, c: F.struct(m["value"].alias("value"), m["before"].alias("before"), F.length(c).alias("counted")),
    )
    nothing = F.expr("cast(array() as array<struct<start:int,end:int,value:string,counted:int>>)")

    def length(m: Column) -> Column:
        return m["before"] + F.length(m["value"])

    def summed_from(chunk: Column, at: Column) -> Column:
        return F.aggregate(
            chunk, F.struct(at.alias("at"), nothing.alias("out")),
            lambda s, m: F.struct(
                (s["at"] + length(m)).alias("at"),
                F.concat(s["out"], F.array(F.struct(
                    (s["at"] + m["before"]).alias("start"), (s["at"] + length(m)).alias("end"),
                    m["value"].alias("value"), m["counted"].alias("counted")))).alias("out")),
            lambda s: s["out"])

    def summed_up(chunks: Column) -> Column:
        lengths = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda n, m: n + length(m)))
        return F.flatten(F.zip_with(chunks, _before(lengths, F.lit(0), lambda n, m: n + m), summed_from))

    summed = _bound(_chunks(placed), summed_up)
    kept = F.filter(summed, lambda m: m["counted"] >= least)
    return F.when(text.rlike(pattern), F.transform(kept, lambda m: m.dropFields("counted"))).otherwise(
        F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)"))


def _above(z: Column) -> Column:
    """Probability of a standard normal value of at least z, by a logistic approximation."""
    z = F.greatest(F.least(z, F.lit(20.0)), F.lit(-20.0))
    return 1 / (1 + F.exp(1.5976 * z + 0.070566 * z * z * z))


def _two_sided(z: Column) -> Column:
    return 2 * _above(F.abs(z))


def _total(array: Column) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda s, x: s + x)


def _encoding(value: Column) -> Column:
    return (
        F.when(value.rlike("^[0-9]+$"), "decimal")
        .when(value.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hexadecimal")
        .when(value.rlike("^(?=.*[2-7])[A-Z2-7]+=*$"), "base32")
        .otherwise("base64")
    )


def p_value(value: Column) -> Column:
    """The p-value of one string; 0 where a test has nothing to vary."""
    encoding = _encoding(value)
    alphabet = F.lit(None).cast("string")
    for name, letters in ALPHABETS.items():
        alphabet = F.when(encoding == name, F.lit(letters)).otherwise(alphabet)
    plain = F.translate(F.regexp_replace(value, "=+$", ""), "-_", "+/")
    plain = F.when(encoding == "hexadecimal", F.lower(plain)).otherwise(plain)

    def tested(s: Column) -> Column:
        x, k = s["x"], s["k"]
        n = F.size(x).cast("double")
        equal = _total(F.transform(
            F.array_distinct(x), lambda d: F.pow(F.size(F.filter(x, lambda y: y == d)).cast("double"), F.lit(2.0))))
        uniform = _above((k / n * equal - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n))

        quarter = _total(F.transform(F.array(*map(F.lit, range(4))), lambda q: F.pow(
            F.size(F.filter(x, lambda y: F.floor(4 * y / k) == q)).cast("double"), F.lit(2.0))))
        quarters = F.when(k % 4 == 0, _above((4 / n * quarter - n - 3) / F.sqrt(6 * (n - 1) / n))).otherwise(1.0)

        before, after = F.slice(x, F.lit(1), F.size(x) - 1), F.slice(x, F.lit(2), F.size(x) - 1)
        high = _total(F.transform(x, lambda y: F.when(y >= k / 2, 1.0).otherwise(0.0)))
        runs = 1 + _total(F.zip_with(
            before, after, lambda a, b: F.when((a >= k / 2) != (b >= k / 2), 1.0).otherwise(0.0)))
        both = 2 * high * (n - high)
        spread = both * (both - n) / (n * n * (n - 1))
        changes = F.when(spread > 0, _two_sided((runs - both / n - 1) / F.sqrt(spread))).otherwise(0.0)

        mean = _total(F.transform(x, lambda y: y.cast("double"))) / n
        variance = _total(F.transform(x, lambda y: (y - mean) * (y - mean)))
        product = _total(F.zip_with(before, after, lambda a, b: (a - mean) * (b - mean)))
        serial = F.when(variance > 0, _two_sided((product / variance + 1 / n) * F.sqrt(n))).otherwise(0.0)
        return F.least(F.lit(1.0), 4 * F.least(uniform, quarters, changes, serial))

    # one struct in an array, so that the numbers of the characters are worked out once
    numbers = F.transform(F.split(plain, ""), lambda c: F.instr(alphabet, c) - 1)
    return F.transform(
        F.array(F.struct(numbers.alias("x"), F.length(alphabet).cast("double").alias("k"))), tested)[0]


def _banded(value: Column) -> Column:
    """Length band and bin of the p-value; a higher bin is a smaller p-value."""
    band = F.lit(0)
    for i, length in enumerate(BANDS):
        band = F.when(F.length(value) >= length, F.lit(i)).otherwise(band)
    p = p_value(value)
    steps = F.when(p > 0, F.floor(-F.log10(p) * STEPS)).otherwise(F.lit(LAST_BIN))
    return F.struct(band.alias("band"), F.least(steps.cast("int"), F.lit(LAST_BIN)).alias("bin"))


def _outside(run: Column, base: Column) -> Column:
    """Pieces of a run, long enough to be tested, that no base span covers."""
    touching = F.array_sort(F.transform(
        F.filter(base, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"])),
        lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"))))
    nothing = F.expr("cast(array() as array<struct<start:int,end:int>>)")
    gaps = F.aggregate(
        touching, F.struct(run["start"].alias("at"), nothing.alias("out")),
        lambda s, b: F.struct(
            F.greatest(s["at"], b["end"]).alias("at"),
            F.concat(s["out"], F.array(F.struct(s["at"].alias("start"), b["start"].alias("end")))).alias("out")),
        lambda s: F.concat(s["out"], F.array(F.struct(s["at"].alias("start"), run["end"].alias("end")))),
    )
    pieces = F.transform(F.filter(gaps, lambda g: g["end"] - g["start"] >= LEAST_RUN), lambda g: F.struct(
        g["start"].alias("start"), g["end"].alias("end"),
        F.substring(run["value"], g["start"] - run["start"] + 1, g["end"] - g["start"]).alias("value")))
    return F.filter(pieces, lambda p: F.length(F.regexp_replace(p["value"], "=+$", "")) >= LEAST_RUN)


def _with_parts(piece: Column) -> Column:
    """A piece, and the parts of it that are long enough to be tested by themselves."""
    parts = F.filter(_found(piece["value"], PART, 0, LEAST_RUN), lambda p: p["value"] != piece["value"])
    return F.concat(F.array(piece), F.transform(parts, lambda p: F.struct(
        (piece["start"] + p["start"]).alias("start"), (piece["start"] + p["end"]).alias("end"),
        p["value"].alias("value"))))


def _runs(text: Column, base: Column) -> Column:
    """Long runs outside base spans, each in an array with its long parts behind it, with band and bin."""
    def outside_all(runs: Column) -> Column:
        near = F.filter(base, lambda b: (b["start"] < F.get(runs, F.size(runs) - 1)["end"])
                        & (F.get(runs, F.lit(0))["start"] < b["end"]))
        return _bound(near, lambda n: F.flatten(F.transform(runs, lambda r: _outside(r, n))))

    pieces = F.flatten(F.transform(_chunks(_found(text, RUN, 0, LEAST_RUN)), outside_all))
    return F.transform(pieces, lambda p: F.transform(_with_parts(p), lambda r: F.struct(
        r["start"].alias("start"), r["end"].alias("end"), _banded(r["value"]).alias("place"))))


def _with_found(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with columns ``found`` (base spans by kind), ``base`` (all of them) and ``runs``."""
    whole = F.coalesce(F.col(text), F.lit(""))
    of_kind = [
        _found(whole, _HEX_SEARCH if kind == "hex" else pattern, group, least).alias(kind)
        for kind, (pattern, group, least) in BASE.items()
    ]
    own = docs.select("*", F.struct(*of_kind).alias("found"))
    own = own.select("*", F.concat(*[F.col(f"found.{kind}") for kind in BASE]).alias("base"))
    return own.select("*", _runs(whole, F.col("base")).alias("runs"))


def rejection_bins(docs: DataFrame, text: str = "text") -> dict[int, int]:
    """For each band the least bin at which randomness is rejected, over all rows of ``docs``.

    Benjamini-Hochberg on the bins' upper ends: the largest p with p <= share * (rows at most p) / rows.
    """
    found = _with_found(docs.select(F.col(text).alias("text")), "text")
    places = found.select(F.explode(F.flatten("runs")).alias("run")).select("run.place")
    counts = places.groupBy("place.band", "place.bin").count()
    smaller = Window.partitionBy("band").orderBy(F.desc("bin"))
    rows = (
        counts.withColumn("below", F.sum("count").over(smaller))
        .withColumn("all", F.sum("count").over(Window.partitionBy("band")))
        .filter(F.pow(F.lit(10.0), -F.col("bin") / STEPS) <= FALSE_SHARE * F.col("below") / F.col("all"))
        .groupBy("band").agg(F.min("bin").alias("bin")).collect()
    )
    return {r["band"]: r["bin"] for r in rows}


def with_spans(docs: DataFrame, rejected: dict[int, int], text: str = "text") -> DataFrame:
    """``docs`` with ``found``, ``base`` and ``all``: sorted spans (start, kind's place, end)."""
    def limit(band: Column) -> Column:
        least = F.lit(LAST_BIN + 1)
        for own, first in rejected.items():
            least = F.when(band == own, F.lit(first)).otherwise(least)
        return least

    def listed(spans: Column, kind: str) -> Column:
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), s["end"].alias("end")))

    found = _with_found(docs, text)
    def passes(run: Column) -> Column:
        return run["place"]["bin"] < limit(run["place"]["band"])

    # a part counts only if the whole does not; parts lie side by side
    random = F.flatten(F.transform("runs", lambda r: F.when(passes(r[0]), F.slice(r, 1, 1)).otherwise(
        F.filter(F.slice(r, F.lit(2), F.size(r)), passes))))
    base = F.array_sort(F.concat(*[listed(F.col(f"found.{kind}"), kind) for kind in BASE]))
    return (
        found.withColumn("base", base)
        .withColumn("all", F.array_sort(F.concat("base", listed(random, RANDOM))))
        .drop("runs")
    )


def _written_out(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n_assign, n_access, n_hex, base_sha256, spans, n_random)`` of every row of ``docs``.

    Spans are written ``kind:start:end`` in code points, by start and then kind. A null or empty text
    has none. Rows of equal text have equal spans; ids are only carried along.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    found = with_spans(rows, rejection_bins(rows), "text")
    return found.select(
        F.col("id").alias(id_column),
        *[F.size(f"found.{kind}").cast("bigint").alias(f"n_{kind}") for kind in BASE],
        F.sha2(_written_out("base").cast("binary"), 256).alias("base_sha256"),
        _written_out("all").alias("spans"),
        (F.size("all") - F.size("base")).cast("bigint").alias("n_random"),
    )


def without_secrets(docs: DataFrame, text: str = "text", instead: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of the text replaced; spans that overlap are replaced as one."""
    columns = docs.columns
    found = with_spans(
        docs.select(F.struct("*").alias("row"), F.col(text).alias("text")), rejection_bins(docs, text), "text")

    def masked_from(chunk: Column, begin: Column) -> Column:
        """The text from ``begin`` to the last span of a chunk, and what stands for that span."""
        own = F.substring(F.col("text"), begin + 1, F.get(chunk, F.size(chunk) - 1)["start"] - begin)
        return _bound(own, lambda part: F.aggregate(
            chunk, F.struct(F.lit("").alias("out"), begin.alias("at")),
            lambda s, span: F.struct(
                F.when(span["start"] >= s["at"], F.concat(
                    s["out"], F.substring(part, s["at"] - begin + 1, span["start"] - s["at"]), F.lit(instead)))
                .otherwise(s["out"]).alias("out"),
                F.greatest(s["at"], span["end"]).alias("at")),
            lambda s: s["out"]))

    def masked_all(chunks: Column) -> Column:
        ends = F.transform(chunks, lambda c: F.array_max(F.transform(c, lambda span: span["end"])))
        return F.array_join(F.zip_with(chunks, _before(ends, F.lit(0), F.greatest), masked_from), "")

    last = F.array_max(F.transform("all", lambda span: span["end"]))
    masked = F.concat(_bound(_chunks(F.col("all")), masked_all), F.substring(F.col("text"), last + 1, F.length("text")))
    clean = F.when(F.size("all") > 0, masked).otherwise(F.col("text"))
    return found.select("row", clean.alias("masked")).select(
        *[F.col("masked").alias(c) if c == text else F.col(f"row.{c}").alias(c) for c in columns])
