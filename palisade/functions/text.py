"""Text expressions: cleaning, chunks, the relevance gate, recognised text, titles."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import reduce

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from palisade import constants as C
from palisade.functions.urls import any_of


def in_slices(values: pa.Array, run: Callable[[list], list], kind: pa.DataType, rows: int = 128) -> pa.Array:
    """run over a batch, so many values at a time: only these are Python objects at once, however many a batch has."""
    done = [pa.array(run(values.slice(i, rows).to_pylist()), kind) for i in range(0, len(values), rows)]
    return pa.concat_arrays(done or [pa.array([], kind)])


def _folded(texts: list) -> list:
    return [None if t is None else t if t.isascii() else unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode("ascii") for t in texts]


@F.arrow_udf(StringType())
def fold(text: pa.Array) -> pa.Array:
    """Compatibility decomposition without what isn't ASCII; Spark SQL has no normalisation form."""
    ascii_only = pc.all(pc.string_is_ascii(text)).as_py()  # None where all are null
    return text.cast(pa.string()) if ascii_only is not False else in_slices(text, _folded, pa.string())


def clean_text(text: Column) -> Column:
    """ASCII only, control characters deleted: words on both sides of a line break are glued, as results expect."""
    return F.regexp_replace(fold(text), r"[\x00-\x1f\x7f]", "")


def clean_text_spaced(text: Column) -> Column:
    """As clean_text, with a space for each run of control characters."""
    return F.trim(F.regexp_replace(fold(text), r"[\x00-\x1f\x7f]+", " "))


def chunks(text: Column, size: int = C.CHUNK_SIZE, overlap: int = C.CHUNK_OVERLAP) -> Column:
    """Pieces of `size` characters, each starting size - overlap after the one before."""
    step = size - overlap
    n = F.char_length(text)
    starts = F.filter(F.sequence(F.lit(0), F.floor(n / step).cast("int")), lambda i: i * step < n)
    return F.transform(starts, lambda i: F.substring(text, (i * step + 1).cast("int"), F.lit(size)))


def has_indicator(text: Column) -> Column:
    return any_of([text.rlike("(?i)" + p) for p in (C.HASH_PATTERN, C.IPV4_PATTERN, C.URL_PATTERN, C.DOMAIN_PATTERN)])


def gate_score(text: Column, count_techniques: bool = False) -> Column:
    """Keywords in the text, plus 2 for a CVE number and 2 for any indicator; techniques count 2 only if asked for."""
    t = F.lower(F.coalesce(text, F.lit("")))
    score = reduce(lambda a, b: a + b, [F.contains(t, F.lit(k)).cast("int") for k in C.GATE_KEYWORDS])
    score = score + 2 * t.rlike(C.CVE_PATTERN).cast("int") + 2 * has_indicator(t).cast("int")
    return score + 2 * t.rlike(C.TECHNIQUE_PATTERN).cast("int") if count_techniques else score


def is_report(text: Column, url: Column) -> Column:
    return ~F.lower(url).rlike(C.TEAM_PAGE_PATTERN) & (gate_score(text) >= C.GATE_MIN_SCORE)


def estimated_tokens(text: Column) -> Column:
    return F.ceil(F.char_length(text) / 3.0)


def logged_tokens(text: Column) -> Column:
    """The rougher estimate that a log shows."""
    return F.floor(F.char_length(text) / 3.4)


def readable(text: Column, min_chars: int = 20) -> Column:
    """Whether recognised text is worth keeping: enough letters, and something technical or plausible words."""
    s = F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", "")
    n = F.char_length(s)
    letters = F.regexp_count(s, F.lit(r"\p{L}"))
    technical = any_of([s.rlike("(?i)" + p) for p in C.TECHNICAL_PATTERNS])
    # words are counted where they stand, without an array of them
    count = F.regexp_count(s, F.lit(r"\S+"))
    single = F.regexp_count(s, F.lit(r"(?<!\S)\S(?!\S)"))
    long = F.regexp_count(s, F.lit(r"\S{3,}"))
    total = n - F.regexp_count(s, F.lit(r"\s"))
    prose = (long >= 3) & (total <= 25 * count) & (single <= 0.4 * count)
    return (n >= min_chars) & (letters >= 0.3 * n) & (prose | technical)


def corrupt_title(title: Column) -> Column:
    """A title that is a piece of prose. Titles that begin with the article "A" or with "I" count as titles."""
    lower = F.lower(title)
    sliced = title.rlike(r"^\p{L} ") & ~title.rlike("^[AI] ")
    dependent = any_of([F.startswith(lower, F.lit(p)) for p in C.TITLE_FRAGMENT_STARTS])
    sentences = F.rtrim(title).endswith(".") & F.contains(title, F.lit(". "))
    return F.coalesce((F.char_length(title) > 200) | sliced | (dependent & sentences), F.lit(False))


def image_reason(width: Column, height: Column) -> Column:
    """Why an image isn't worth reading, null if it is."""
    aspect = F.try_divide(width.cast("double"), height.cast("double"))
    size = F.concat(F.lit(" ("), width.cast("string"), F.lit("x"), height.cast("string"), F.lit(")"))
    return (
        F.when((width < 200) | (height < 100), F.concat(F.lit("too small"), size))
        .when((width > 3000) | (height > 3000), F.concat(F.lit("too large"), size))
        .when((aspect > 8) | (aspect < 0.2), F.concat(F.lit("extreme aspect ratio ("), F.format_string("%.1f", aspect), F.lit(":1)")))
        .when(width.between(180, 400) & height.between(180, 400) & (F.abs(width - height) < 60), F.concat(F.lit("likely logo"), size))
    )


def decodable(content_type: Column) -> Column:
    kind = F.lower(F.trim(F.regexp_extract(F.coalesce(content_type, F.lit("")), "^([^;]*)", 1)))
    return (kind == "") | kind.isin(*C.DECODABLE_TYPES)
