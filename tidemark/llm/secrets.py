"""Secret scans: fixed patterns, and a battery of randomness tests on other token-like strings.

Strings of the characters that keys are written in are tested for being uniform draws from the
alphabet of their encoding: chi-squared over classes of symbols, Wald-Wolfowitz runs about the
middle of the alphabet, and lag-one serial correlation. The three p-values are combined by Fisher's
method. Random strings have uniform p-values, ordinary words pile up near zero; how far a p-value
has to be from zero depends on the length, since short words pass easily. So for each encoding and
length class the p-values of *all* documents are counted, and the cut is the smallest one beyond
which the estimated share of ordinary strings is at most ``false_discovery``. Classes with few
strings are counted together with the next ones.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import stored

# Fixed patterns and the least length of what counts: group 2 for the first, the match for the others.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the maximal runs of 24 and more
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex", "random")
_ASSIGN_HINT = ("passw", "secret", "token", "api")

LEAST = 20  # shorter strings are too few symbols to test
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_-]{{{LEAST},}}={{0,2}}")
# Keys stand between such signs in paths and names, and some encodings have them as symbols.
_SEPARATORS = (re.compile(r"[/+]"), re.compile(r"[_-]"), re.compile(r"[/+_-]"))
BINS = 50
ENOUGH = 50  # strings to estimate from
LENGTH_CLASSES = (24, 32, 40, 64)  # upper ends, the last class is open

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Alphabets from narrow to wide, in the order of their symbols' values, with the classes that the
# chi-squared test counts.
ENCODINGS = {
    "hex": (_DIGITS + "abcdef", 4),
    "HEX": (_DIGITS + "ABCDEF", 4),
    "base32": (_UPPER + "234567", 4),
    "alphanumeric lower": (_LOWER + _DIGITS, 4),
    "alphanumeric upper": (_UPPER + _DIGITS, 4),
    "letters": (_UPPER + _LOWER, 4),
    "alphanumeric": (_UPPER + _LOWER + _DIGITS, 5),
    "base64": (_UPPER + _LOWER + _DIGITS + "+/", 5),
    "base64url": (_UPPER + _LOWER + _DIGITS + "-_", 5),
}
_VALUES = {name: {c: i for i, c in enumerate(alphabet)} for name, (alphabet, _) in ENCODINGS.items()}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans of the fixed patterns as (start, kind, end), by start and kind; leftmost and not
    overlapping within a kind. A match that is too short is dropped after it has used its place."""
    spans = []
    low = text.lower()
    if any(hint in low for hint in _ASSIGN_HINT):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def encoding_of(token: str) -> str | None:
    """The narrowest encoding that the string is written in; trailing = signs do not count."""
    symbols = set(token.rstrip("="))
    return next((name for name in ENCODINGS if symbols <= _VALUES[name].keys()), None)


def _chi_squared_tail(x: float, degrees: int) -> float:
    """Upper tail of the chi-squared distribution, by the finite sums for whole degrees."""
    if x <= 0:
        return 1.0
    half = x / 2
    if degrees % 2 == 0:
        term = total = math.exp(-half)
        for k in range(1, degrees // 2):
            term *= half / k
            total += term
        return min(1.0, total)
    total = math.erfc(math.sqrt(half))
    term = math.exp(-half) * math.sqrt(half) / math.gamma(1.5)
    for k in range(1, (degrees + 1) // 2):
        total += term
        term *= half / (k + 0.5)
    return min(1.0, total)


def randomness(token: str, encoding: str) -> float:
    """Combined p-value of the battery: small for strings that are not uniform draws."""
    alphabet, classes = ENCODINGS[encoding]
    size, values = len(alphabet), _VALUES[encoding]
    x = np.array([values[c] for c in token.rstrip("=")], dtype=np.float64)
    n = len(x)
    edges = np.linspace(0, size, classes + 1).round()
    expected = np.diff(edges) / size * n
    observed = np.histogram(x, edges)[0]
    p_uniform = _chi_squared_tail(float(((observed - expected) ** 2 / expected).sum()), classes - 1)
    high = x >= size / 2
    above = int(high.sum())
    below = n - above
    if above and below:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 1 + 2 * above * below / n
        spread = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
        p_runs = math.erfc(abs(runs - mean) / math.sqrt(2 * spread))
    else:
        p_runs = 0.0
    centred = x - x.mean()
    power = float((centred**2).sum())
    if power > 0:
        r = float((centred[1:] * centred[:-1]).sum()) / power
        p_serial = math.erfc(abs(r + 1 / n) * math.sqrt(n) / math.sqrt(2))
    else:
        p_serial = 0.0
    fisher = -2 * sum(math.log(max(p, 1e-300)) for p in (p_uniform, p_runs, p_serial))
    return _chi_squared_tail(fisher, 6)


def _length_class(n: int) -> int:
    return sum(n > top for top in LENGTH_CLASSES)


def _parts(token: str) -> list[tuple[int, int]]:
    """The string and its parts between separators, of either kind and of both, that are long enough."""
    found = {(0, len(token))}
    for separator in _SEPARATORS:
        at = 0
        for m in separator.finditer(token):
            found.add((at, m.start()))
            at = m.end()
        found.add((at, len(token)))
    return sorted((a, b) for a, b in found if len(token[a:b].rstrip("=")) >= LEAST)


def candidates(text: str) -> list[tuple[int, int, str, float]]:
    """Token-like strings as (start, end, encoding and length class, p-value), which may overlap: what
    holds separators is tested in parts, and as a whole if one encoding has all its symbols.

    Strings of letters in one case alone are left out: no test tells them from a long word.
    """
    out = []
    for m in _CANDIDATE.finditer(text):
        for a, b in _parts(m.group()):
            token = m.group()[a:b]
            if (encoding := encoding_of(token)) and not (token.isalpha() and (token.islower() or token.isupper())):
                n = len(token.rstrip("="))
                out.append((m.start() + a, m.start() + b, f"{encoding}/{_length_class(n)}", randomness(token, encoding)))
    return out


_SPAN = "array<struct<start:long,kind:int,end:long>>"
_FOUND = "array<struct<start:long,end:long,stratum:string,p:double>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, ``base`` (spans of the fixed patterns) and ``found``
    (candidates of the battery). Positions are code points, ends exclusive."""
    kind = docs.schema[id_col].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    cand = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("stratum", pa.string()), ("p", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, found = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                base.append([{"start": s, "kind": k, "end": e} for s, k, e in base_spans(text)])
                found.append([{"start": s, "end": e, "stratum": x, "p": p} for s, e, x, p in candidates(text)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, span), pa.array(found, cand)], names=[id_col, "base", "found"]
            )

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, base {_SPAN}, found {_FOUND}")


def thresholds(scanned: DataFrame, false_discovery: float) -> dict[str, float]:
    """The least accepted p-value of each encoding and length class; classes without one accept none.

    Random strings have uniform p-values, so twice the count above 1/2 estimates them (1/2 and more
    hold next to no ordinary strings), and what a cut accepts beyond its share of these is false.
    A class with less than :data:`ENOUGH` strings is counted together with the next length class, and
    the last ones of an encoding with the next encoding. If all documents have less, one more string
    above 1/2 is assumed, so that a lone key is not lost because it is alone.
    """
    counts = (
        scanned.select(F.explode("found").alias("f"))
        .select("f.stratum", F.least(F.floor(F.col("f.p") * BINS), F.lit(BINS - 1)).alias("bin"))
        .groupBy("stratum", "bin")
        .count()
        .collect()  # at most encodings x length classes x bins rows
    )
    by_stratum: dict[str, np.ndarray] = {}
    for row in counts:
        by_stratum.setdefault(row["stratum"], np.zeros(BINS))[row["bin"]] = row["count"]
    pools: list[tuple[list[str], np.ndarray]] = []
    for stratum in (f"{encoding}/{n}" for encoding in ENCODINGS for n in range(len(LENGTH_CLASSES) + 1)):
        if stratum in by_stratum:
            if not pools or pools[-1][1].sum() >= ENOUGH:
                pools.append(([], np.zeros(BINS)))
            pools[-1][0].append(stratum)
            pools[-1][1][:] += by_stratum[stratum]
    if len(pools) > 1 and pools[-1][1].sum() < ENOUGH:
        names, bins = pools.pop()
        pools[-1][0].extend(names)
        pools[-1][1][:] += bins
    out = {}
    for names, bins in pools:
        random = 2 * (bins[BINS // 2 :].sum() + (bins.sum() < ENOUGH))
        accepted = bins[::-1].cumsum()[::-1]
        for k in range(1, BINS):
            false = max(0.0, accepted[k] - random * (1 - k / BINS))
            if accepted[k] and false / accepted[k] <= false_discovery and random >= 1:
                out.update(dict.fromkeys(names, k / BINS))
                break
    return out


def find_secrets(
    docs: DataFrame, false_discovery: float = 0.05, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: ``id_col``, ``base`` and ``spans``, arrays of (start, kind, end) by start
    and kind; ``kind`` counts in :data:`KINDS`. ``spans`` holds ``base`` and the random strings that
    overlap none of it and are no part of another one.

    Null and empty texts have no spans. Ids may be null or repeat. Columns other than the id and the
    text are not read.
    """
    scanned = stored(scan(docs, id_col, text_col), "secret-scan")
    cuts = thresholds(scanned, false_discovery)
    cut = F.create_map(*[F.lit(x) for pair in cuts.items() for x in pair]) if cuts else F.create_map().cast("map<string,double>")
    overlaps = lambda f: F.exists("base", lambda b: (b["start"] < f["end"]) & (f["start"] < b["end"]))
    kept = F.filter("found", lambda f: (f["p"] >= F.try_element_at(cut, f["stratum"])) & ~overlaps(f))
    inside = lambda f, g: (g["start"] <= f["start"]) & (f["end"] <= g["end"]) & (g["end"] - g["start"] > f["end"] - f["start"])
    whole = F.filter("kept", lambda f: ~F.exists("kept", lambda g: inside(f, g)))
    added = F.transform(
        whole, lambda f: F.struct(f["start"].alias("start"), F.lit(3).alias("kind"), f["end"].alias("end"))
    )
    return scanned.select(id_col, "base", kept.alias("kept")).select(
        id_col, "base", F.array_sort(F.concat("base", added)).alias("spans")
    )


def spans_text(spans) -> F.Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


MASK = "[secret]"


def masked(text: str, cuts: dict[str, float]) -> str:
    """The text with each secret replaced by :data:`MASK`; overlapping spans become one."""
    base = base_spans(text)
    spans = [(s, e) for s, _, e in base]
    spans += [(s, e) for s, e, x, p in candidates(text) if p >= cuts.get(x, 2.0) and not any(a < e and s < b for a, _, b in base)]
    out, at = [], 0
    for s, e in sorted(spans):
        if s >= at:
            out += [text[at:s], MASK]
        at = max(at, e)
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, false_discovery: float = 0.05, text_col: str = "text", n_chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with the secrets in the text masked, and ``n_chars_col``, where there is one, as long as
    the text is then. All rows and columns are kept; null texts stay null."""
    first = docs.columns[0]
    scanned = stored(scan(docs, first, text_col).select("found"), "secret-scan")
    cuts = thresholds(scanned, false_discovery)
    names, text_at = docs.columns, docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [masked(t, cuts) if t else t for t in batch.column(text_at).to_pylist()]
            columns = list(batch.columns)
            columns[text_at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    out = docs.mapInArrow(run, docs.schema)
    if n_chars_col in names:
        kind = docs.schema[n_chars_col].dataType
        out = out.withColumn(n_chars_col, F.coalesce(F.char_length(text_col).cast(kind), F.col(n_chars_col)))
    return out
