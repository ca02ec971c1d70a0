"""Personal data: plain patterns, and a character tagger (bidirectional LSTM with a CRF) that adds to them.

The patterns (:func:`base_spans`) find regular e-mail addresses, IPv4 addresses, payment card numbers and
phone numbers; each is followed in time linear in the text. Their finds label windows of text, and a bounded
sample of these teaches the tagger. It is also taught forms that the patterns don't know, made from
the sample: two finds in a row, numbers in other groupings, phone numbers without a plus sign, addresses
with ``[at]`` and ``[dot]``, IP addresses with ``[.]``.

Every find holds a digit, an ``@`` or a bracketed word, so the tagger reads what lies within ``REACH`` of
such characters, however much of the text that is, in windows that overlap by half. The windows' scores are blended, each
counting most in its middle, and one Viterbi pass over the joined stretch decodes them. A decoded span is
kept if it passes the checks of its kind and overlaps no span of a pattern.

Defined cases: a null or empty text has no spans. Repeated rows and rows without an id are handled each.
Without any find to learn from there is no tagger, and the patterns' spans are all. Positions are code
points, ends exclusive. Other columns are carried along or not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bikenet.llm.char_tagger import Tagger, codes_of
from bikenet.llm.text_arrays import texts_of

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

#: Windows that teach, at most, of each kind and of stretches without a find.
PER_KIND = 500
SHARES = 64
#: Characters of a window, and around a digit or mark.
WINDOW, REACH = 96, 40
#: Batches that teach, whatever the sample's size, windows of one, and Adam's rate at first.
STEPS, BATCH, RATE = 350, 60, 0.012
#: Windows that teach with those made of them, at least.
LEAST_TAUGHT = 2000
#: Windows of one pass through the LSTM, and stretches of one Viterbi pass.
PASS = 256

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DOTTED = re.compile(r"[0-9.]+")
_DIGITS = re.compile(r"[0-9]+")
_ANCHOR = re.compile(r"[0-9@]|[\[({] ?(?:at|dot) ?[\])}]", re.I)
_AT, _DOT = r" ?(?:@|[\[({] ?at ?[\])}]) ?", r" ?(?:\.|[\[({] ?dot ?[\])}]) ?"
_ANY_EMAIL = re.compile(rf"[A-Za-z0-9._%+-]+{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+", re.I)
_ANY_IP = re.compile(r"[0-9]{1,3}(?:[\[({]?\.[\])}]?[0-9]{1,3}){3}")
_ANY_CARD = re.compile(r"[0-9](?:[ ./-]?[0-9])+")
_ANY_PHONE = re.compile(r"[+(]?[0-9][0-9 ()./-]+[0-9]")

#: Bytes without which a text has no find.
_TOLD = np.zeros(256, dtype=bool)
_TOLD[[*range(48, 58), *b"@[({"]] = True


def passes_luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) << (place & 1)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _byte(part: str) -> bool:
    return len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255


def _matches(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """``(kind, start, end, passed)`` of every leftmost match of the patterns."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield EMAIL, start, done, True
        at = text.find("@", at + 1)
    for run in _DOTTED.finditer(text):
        if run.group().count(".") < 3:
            continue
        parts = list(_DIGITS.finditer(text, *run.span()))
        i = 0
        while i + 3 < len(parts):
            four = parts[i : i + 4]
            if all(b.start() - a.end() == 1 for a, b in zip(four, four[1:])):
                yield IP, four[0].start(), four[3].end(), all(_byte(p.group()) for p in four)
                i += 4
            else:
                i += 1
    for kind, pattern in ((CARD, _CARD), (PHONE, _PHONE)):
        for match in pattern.finditer(text):
            digits = "".join(_DIGITS.findall(match.group()))
            passed = 13 <= len(digits) <= 19 and passes_luhn(digits) if kind == CARD else 9 <= len(digits) <= 15
            yield kind, *match.span(), passed


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of what the patterns find, by kind, then start."""
    return sorted(m[:3] for m in _matches(text) if m[3])


def valid(kind: int, text: str) -> bool:
    """Whether a text can be personal data of that kind, in any of the forms taught."""
    digits = "".join(_DIGITS.findall(text))
    if kind == EMAIL:
        return bool(_ANY_EMAIL.fullmatch(text))
    if kind == IP:
        return bool(_ANY_IP.fullmatch(text)) and all(_byte(p) for p in _DIGITS.findall(text))
    if kind == CARD:
        return bool(_ANY_CARD.fullmatch(text)) and 13 <= len(digits) <= 19 and passes_luhn(digits)
    plus = text.startswith("+")
    grouped = any(c in text for c in " ()./-")
    return bool(_ANY_PHONE.fullmatch(text)) and (9 if plus else 10) <= len(digits) <= 15 and (plus or grouped)


def stretches(text: str) -> list[tuple[int, int]]:
    """Where the tagger reads: all within ``REACH`` of a digit or mark."""
    found: list[list[int]] = []
    for match in _ANCHOR.finditer(text):
        low, high = max(0, match.start() - REACH), min(len(text), match.end() + REACH)
        if found and low <= found[-1][1]:
            found[-1][1] = high
        else:
            found.append([low, high])
    return [(low, high) for low, high in found]


def windows_that_teach(text: str) -> Iterator[tuple[int, str, str]]:
    """``(kind, window, tags)``: a window around each find, and one (kind 4) around the first mark far from any.

    Windows that hold a match which failed its check are left out: they are neither one nor the other.
    """
    matches = list(_matches(text))
    good = sorted((a, b, kind) for kind, a, b, passed in matches if passed)
    doubtful = [(a, b) for kind, a, b, passed in matches
                if not passed and (kind != CARD or sum(c.isdigit() for c in text[a:b]) > 8)]
    centres = [(kind, (a + b) // 2) for a, b, kind in good]
    for low, high in stretches(text):
        if not any(a < high and low < b for a, b, _ in good):
            centres.append((len(KINDS), (low + high) // 2))
            break
    for kind, centre in centres:
        low = max(0, min(centre - WINDOW // 2, len(text) - WINDOW))
        high = min(len(text), low + WINDOW)
        if any(a < high and low < b for a, b in doubtful):
            continue
        tags = ["0"] * (high - low)
        for a, b, own in good:
            if low <= a and b <= high:
                tags[a - low : b - low] = [str(2 * own + 1)] + [str(2 * own + 2)] * (b - a - 1)
            elif a < high and low < b:
                tags = []  # cut by the window
                break
        if tags:
            yield kind, text[low:high], "".join(tags)


def _reshaped(kind: int, rng: np.random.Generator) -> str:
    """Another datum of the kind, in a form that the patterns need not know."""
    letters = "abcdefghijklmnopqrstuvwxyz0123456789"

    def word(low: int, high: int) -> str:
        return "".join(letters[k] for k in rng.integers(0, len(letters), rng.integers(low, high)))

    if kind == EMAIL:
        local = word(2, 9) + ("" if rng.random() < 0.5 else "._-"[rng.integers(3)] + word(2, 8))
        names = [word(2, 9) for _ in range(rng.integers(1, 3))] + [("com", "org", "net", "de", "fr", "io")[rng.integers(6)]]
        left, right = (("[", "]"), ("(", ")"), ("{", "}"))[rng.integers(3)]
        gap = " " if rng.random() < 0.5 else ""
        form = rng.random()
        at = "@" if form < 0.4 else f"{gap}{left}at{right}{gap}"
        dot = "." if form < 0.7 else f"{gap}{left}dot{right}{gap}"
        return local + at + dot.join(names)
    if kind == IP:
        parts = [str(p) for p in rng.integers(0, 256, 4)]
        return ("." if rng.random() < 0.5 else "[.]").join(parts)
    digits = "".join(letters[26 + k] for k in rng.integers(0, 10, 10 if kind == PHONE else 16))
    if kind == CARD:
        gap = " -./"[rng.integers(4)]
        return gap.join(digits[k : k + 4] for k in range(0, 16, 4)) if rng.random() < 0.7 else digits
    a, b, c = digits[:3], digits[3:6], digits[6:]
    body = (f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"({a}){b}-{c}")[rng.integers(5)]
    return (f"+{rng.integers(1, 99)}{' -'[rng.integers(2)]}" if rng.random() < 0.5 else "") + body


def taught_forms(windows: list[tuple[str, str]], seed: int = 1) -> list[tuple[str, str]]:
    """The windows, each also with a span reshaped and with a second datum behind one.

    Few windows go round several times, each time made anew.
    """
    rng = np.random.default_rng(seed)
    out = []
    pool = [(int(tags[a]) // 2, text[a:b]) for text, tags in windows for a, b in _runs(tags)]
    rounds = -(-LEAST_TAUGHT // max(1, 3 * len(windows)))
    for text, tags in windows * rounds:
        runs = _runs(tags)
        if not runs:
            continue
        for follow in (False, True):
            a, b = runs[rng.integers(len(runs))]
            kind = int(tags[a]) // 2
            data = [(kind, text[a:b] if follow and rng.random() < 0.7 else _reshaped(kind, rng))]
            if follow:
                other, value = pool[rng.integers(len(pool))]
                data.append((other, value if rng.random() < 0.7 else _reshaped(other, rng)))
            middle = " ".join(value for _, value in data)
            marks = "0".join(str(2 * k + 1) + str(2 * k + 2) * (len(value) - 1) for k, value in data)
            whole, all_tags = text[:a] + middle + text[b:], tags[:a] + marks + tags[b:]
            low = max(0, min(a + len(middle) // 2 - WINDOW // 2, len(whole) - WINDOW))
            cut = all_tags[low : low + WINDOW]
            if cut[0] in "01357" and (len(all_tags) <= low + WINDOW or all_tags[low + WINDOW] in "01357"):
                out.append((whole[low : low + WINDOW], cut))
    return windows * rounds + out


def _runs(tags: str) -> list[tuple[int, int]]:
    """Spans of a tag string."""
    return [m.span() for m in re.finditer("12*|34*|56*|78*", tags)]


def fit(docs: DataFrame, text: str = "text") -> Tagger | None:
    """A tagger taught by a bounded sample of the patterns' finds; ``None`` without any.

    Of each kind the windows with the least hash teach, so every run takes the same.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [x for _, t in _told(batch.column(0)) for x in windows_that_teach(t)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string()),
                 pa.array([r[2] for r in rows], pa.string())], ["kind", "window", "tags"])

    found = docs.select(F.col(text).alias("text")).mapInArrow(run, "kind int, window string, tags string").distinct()
    # first within shares, so that no task gets more of a kind than the shares' bounds
    sample = found.withColumn("hash", F.xxhash64("window"))
    for keys in (["kind", F.pmod("hash", F.lit(SHARES))], ["kind"]):
        order = Window.partitionBy(*keys).orderBy("hash", "window")
        sample = sample.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= PER_KIND)
    rows = sample.orderBy("kind", "place").toArrow().to_pylist()
    if not any(r["kind"] < len(KINDS) for r in rows):
        return None
    windows = taught_forms([(r["window"], r["tags"]) for r in rows])
    codes = np.zeros((len(windows), WINDOW), dtype=np.int64)
    tags = np.zeros((len(windows), WINDOW), dtype=np.int64)
    for k, (window, own) in enumerate(windows):
        codes[k, : len(window)] = codes_of(window)
        tags[k, : len(own)] = [int(tag) for tag in own]
    tagger = Tagger(len(KINDS))
    tagger.train(codes, tags, STEPS, BATCH, RATE)
    return tagger


def blended_scores(tagger: Tagger, pieces: list[np.ndarray]) -> list[np.ndarray]:
    """Tag scores of each stretch: those of windows that overlap by half, each weighed by the distance from its edge."""
    half = WINDOW // 2
    weight = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)
    at = [(k, start) for k, piece in enumerate(pieces) for start in range(0, max(1, len(piece) - half), half)]
    sums = [np.zeros((len(piece), tagger.tags), dtype=np.float32) for piece in pieces]
    shares = [np.zeros(len(piece), dtype=np.float32) for piece in pieces]
    for low in range(0, len(at), PASS):
        codes = np.zeros((WINDOW, len(at[low : low + PASS])), dtype=np.int64)
        for column, (k, start) in enumerate(at[low : low + PASS]):
            own = pieces[k][start : start + WINDOW]
            codes[: len(own), column] = own
        scores = tagger.emissions(codes)
        for column, (k, start) in enumerate(at[low : low + PASS]):
            size = min(WINDOW, len(pieces[k]) - start)
            sums[k][start : start + size] += scores[:size, column] * weight[:size, None]
            shares[k][start : start + size] += weight[:size]
    return [total / share[:, None] for total, share in zip(sums, shares)]


def decoded(tagger: Tagger, pieces: list[np.ndarray]) -> list[np.ndarray]:
    """The tags of each stretch by one Viterbi pass over all of it."""
    scores = blended_scores(tagger, pieces)
    out: list[np.ndarray] = [None] * len(pieces)  # type: ignore[list-item]
    order = sorted(range(len(pieces)), key=lambda k: len(pieces[k]))
    for low in range(0, len(order), PASS):
        chosen = order[low : low + PASS]
        # stretches of very unequal length are not padded to each other
        while chosen:
            size = len(pieces[chosen[0]])
            group = [k for k in chosen if len(pieces[k]) <= 2 * size]
            chosen = chosen[len(group):]
            steps = len(pieces[group[-1]])
            padded = np.full((steps, len(group), tagger.tags), -1e4, dtype=np.float32)
            padded[:, :, 0] = 0
            for column, k in enumerate(group):
                padded[: len(scores[k]), column] = scores[k]
            tags = tagger.decode(padded)
            for column, k in enumerate(group):
                out[k] = tags[: len(scores[k]), column]
    return out


def added_spans(tagger: Tagger, texts: list[str], base: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
    """What the tagger finds in each text beside the patterns' spans."""
    where = [(row, low, high) for row, text in enumerate(texts) for low, high in stretches(text)]
    tags = decoded(tagger, [codes_of(texts[row][low:high]) for row, low, high in where])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for (row, low, _), own in zip(where, tags):
        text, taken = texts[row], base[row]
        for begin in np.flatnonzero(own % 2 == 1):
            kind, end = int(own[begin]) // 2, int(begin) + 1
            while end < len(own) and own[end] == own[begin] + 1:
                end += 1
            a, b = low + int(begin), low + end
            while a < b and text[a] in " .,;:/-\n":
                a += 1
            while a < b and text[b - 1] in " .,;:/-(\n":
                b -= 1
            outside = text[a - 1 : a] + text[b : b + 1]
            if (a < b and not any(c.isalnum() for c in outside) and valid(kind, text[a:b])
                    and not any(x < b and a < y for _, x, y in taken)):
                out[row].append((kind, a, b))
    return out


def _told(column: pa.Array) -> Iterator[tuple[int, str]]:
    """Rows that hold a digit or mark, with their texts."""
    data, offsets = texts_of(column)
    rows = np.unique(np.searchsorted(offsets, np.flatnonzero(_TOLD[data[offsets[0] : offsets[-1]]]) + offsets[0], side="right") - 1)
    for row in rows.tolist():
        yield row, column[row].as_py()


def spans_of(column: pa.Array, tagger: Tagger | None) -> dict[int, list[tuple[int, int, int, bool]]]:
    """``(kind, start, end, base)`` of each row that has any, by kind, then start."""
    told = list(_told(column))
    base = [base_spans(text) for _, text in told]
    added = added_spans(tagger, [text for _, text in told], base) if tagger and told else [[] for _ in told]
    return {row: sorted([(*s, True) for s in own] + [(*s, False) for s in more])
            for (row, _), own, more in zip(told, base, added) if own or more}


SPANS = "array<struct<kind: string, start: int, end: int, base: boolean>>"


def find_personal(docs: DataFrame, tagger: Tagger | None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, spans)`` of every row; ``base`` tells the patterns' spans from those of the tagger."""
    frame = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    kind = frame.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])
        for batch in batches:
            found = spans_of(batch.column(1), tagger)
            spans = [[dict(zip(("kind", "start", "end", "base"), (KINDS[s[0]], *s[1:]))) for s in found.get(row, ())]
                     for row in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(fields))], ["id", "spans"])

    return frame.mapInArrow(run, f"id {kind}, spans {SPANS}").withColumnRenamed("id", id_column)


def without_personal(docs: DataFrame, tagger: Tagger | None, text: str = "text") -> DataFrame:
    """All rows and columns, with every span replaced by its kind in angle brackets."""
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(place).to_pylist()
            for row, spans in spans_of(batch.column(place), tagger).items():
                whole, parts, done = texts[row], [], 0
                for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
                    if start >= done:
                        parts += [whole[done:start], f"<{KINDS[kind]}>"]
                    done = max(done, end)
                texts[row] = "".join(parts) + whole[done:]
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    return docs.mapInArrow(run, docs.schema)


def span_list(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def personal_data(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and digest of the patterns' spans of every row, and all spans."""
    found = find_personal(docs, fit(docs, text), id_column, text)
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return found.select(
        id_column, *counts, F.sha2(span_list(base).cast("binary"), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"), (F.size("spans") - F.size(base)).cast("bigint").alias("n_added"),
    )
