"""Turkish casing, word splitting and channel names: as Column expressions and for Arrow batches.

Spark has no Unicode normalisation, so what needs NFC runs in Arrow batches; all else stays in the JVM.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = re.compile(r"[^\W_]+")
DIGITS = re.compile(r"\d+")

# The Turkish letters whose case mapping differs from the default, upper and lower.
TR_UPPER = "IİÇĞÖŞÜ"
TR_LOWER = "ıiçğöşü"


def nfc(text: str) -> str:
    return text if text.isascii() or unicodedata.is_normalized("NFC", text) else unicodedata.normalize("NFC", text)


def tr_lower(text: str) -> str:
    """Turkish lower case: I to dotless i, dotted I to i, then the default mapping."""
    return text.replace("I", "ı").replace("İ", "i").lower()


def words(text: str) -> list[str]:
    """NFC, Turkish lower case, maximal runs of letters and digits."""
    return WORD.findall(tr_lower(nfc(text)))


def channel_name(name: str | None) -> str | None:
    """NFC, Turkish lower case, white space collapsed and trimmed; null stays null, blank becomes ''."""
    return None if name is None else " ".join(tr_lower(nfc(name)).split())


def channel_names(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """``channel_name`` over an Arrow column; each distinct value is worked out once."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    d = column.dictionary_encode()
    names = pa.array([channel_name(x) for x in d.dictionary.to_pylist()], pa.string())
    return names.take(d.indices)


@F.pandas_udf(T.StringType())
def _channel_udf(s):  # noqa: ANN001, ANN202
    known = {x: channel_name(x) for x in s.dropna().unique()}
    return s.map(known)


def channel_key(c: Column | str) -> Column:
    """Channel name as a Column (Arrow batches, once per distinct value of a batch)."""
    return _channel_udf(c)


def lower_tr(c: Column) -> Column:
    return F.lower(F.translate(c, TR_UPPER, TR_LOWER))


def upper_tr(c: Column) -> Column:
    return F.upper(F.translate(c, TR_LOWER, TR_UPPER))


def let(value: Column, use) -> Column:  # noqa: ANN001
    """``use(value)`` with ``value`` worked out once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def romanised(c: Column) -> Column:
    """Letters of a token as an aligner's vocabulary has them: Turkish lower case, plain letters, one blank between; null where nothing is left (figures, marks)."""
    plain = F.regexp_replace(F.translate(lower_tr(c), "çğıöşüâîû", "cgiosuaiu"), r"[^a-z']", "")
    spaced = F.trim(F.regexp_replace(plain, "(.)", "$1 "))
    return F.when(spaced != "", spaced)


def model_name(c: Column) -> Column:
    """Last part of a model's path, without the prefixes of converted weights."""
    return F.regexp_replace(F.element_at(F.split(c, "/"), -1), r"^faster-|^whisper-", "")


# Closing marks that may follow a sentence's end, and the marks that end one.
CLOSERS = "\"'»”’)]}"
SENTENCE_END = ".!?…"
_CLOSERS_RE = r"""["'»”’)\]}\s]"""


@F.pandas_udf(T.StringType())
def _nfc_udf(s):  # noqa: ANN001, ANN202
    return s.map(nfc, na_action="ignore")


# A text of these characters alone is in NFC: none of them composes or decomposes, and combining marks are not among them.
PLAIN = r"^[\x00-\u02ff\u2002-\u206f\u20a0-\u20bf]*$"


def nfc_text(c: Column | str) -> Column:
    """NFC of a column; null stays null. Only texts with other than plain characters go to Python."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(_nfc_udf(F.when(~c.rlike(PLAIN), c)), c)


def dedupe_key(c: Column, normalise: bool = True) -> Column:
    """Comparison key: NFC, Turkish lower case, all but word characters to blanks, white space collapsed and trimmed."""
    c = lower_tr(nfc_text(c) if normalise else c)
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"[^\p{L}\p{N}_\s]", " "), r"(?U)\s+", " "))


def holds_phrase(c: Column, phrase: Column) -> Column:
    """Whether the words of ``phrase`` stand in a row in ``c``, by comparison keys; an empty phrase stands nowhere."""
    whole = lambda x: F.concat(F.lit(" "), dedupe_key(x), F.lit(" "))
    return F.contains(whole(c), whole(phrase)) & (dedupe_key(phrase) != "")


def collapse(c: Column) -> Column:
    """White space (no-break included) to single blanks, runs of one of . , ! ? ; : to one, trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", " "), r"([.,!?;:])\1+", "$1"))


light_clean = collapse


def strip_closers(c: Column) -> Column:
    return F.regexp_replace(c, _CLOSERS_RE + "+$", "")


def has_sentence_end(c: Column) -> Column:
    """Ends with a sentence mark, closing marks aside; null is false."""
    return F.coalesce(strip_closers(c).rlike(r"[.!?…]$"), F.lit(False))


def is_lower_start(c: Column) -> Column:
    """The first letter or digit is a letter in lower case (Turkish); digits and texts without either are not broken."""
    first = F.regexp_extract(c, r"([\p{L}\p{Nd}])", 1)
    return F.coalesce(first.rlike(r"\p{L}") & (first == lower_tr(first)) & (first != upper_tr(first)), F.lit(False))


def cer(ref: Column, hyp: Column, normalise: bool = True) -> Column:
    """Character error rate of normalised texts: Levenshtein distance over the reference's length; null for an empty reference."""
    a, b = dedupe_key(ref, normalise), dedupe_key(hyp, normalise)
    return F.when(F.length(a) > 0, F.levenshtein(a, b) / F.length(a))
