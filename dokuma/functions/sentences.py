"""Sentence boundaries and clitics over token arrays, as Column expressions without shuffle or Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, lower_tr, strip_closers

# Abbreviations whose full stop ends no sentence.
ABBREVIATIONS = (
    "dr doç prof yrd av sn sayın alb gen yzb hz st mah cad sok apt no tel faks bkz örn yak çev haz ed der yay bas vb vs vd age agy yy as ms mö sf s c bl böl şb tic ltd şti a.ş mim müh uzm öğr gör arş ing alm fr osm"
).split()
# Words after an ordinal ("3. Bölüm"), and words before a number that is a name ("Bölüm 5.").
ORDINAL_FOLLOWERS = "bölüm kitap cilt kısım perde sayı baskı dünya".split()
NUMBER_LABELS = "bölüm madde sayfa kısım cilt fasıl bap ayet sure sayı no".split()
ORDINAL_DIGITS = 3


def token_core(t: Column) -> Column:
    """A token without closing and sentence marks and outer , ; : dashes, in Turkish lower case."""
    return F.regexp_replace(lower_tr(F.regexp_replace(strip_closers(t), r"[.!?…]+$", "")), r"^[,;:—\-–]+|[,;:—\-–]+$", "")


def starts_sentence(t: Column) -> Column:
    """First significant character is a capital or a digit."""
    return F.coalesce(t.rlike(r"""^["'»”’)\]}«(\-—]*[\p{Lu}\p{Lt}\p{Nd}]"""), F.lit(False))


def is_boundary(prev: Column, cur: Column, nxt: Column) -> Column:
    """Whether ``cur`` ends a sentence; prev and nxt are null at the ends."""
    bare, core = strip_closers(cur), token_core(cur)
    number = core.rlike(r"^\p{Nd}+$")
    abbreviation = core.isin(ABBREVIATIONS) | core.rlike(r"^\p{L}$") | (core.contains(".") & F.replace(core, F.lit("."), F.lit("")).isin(ABBREVIATIONS))
    ordinal = (F.length(core) <= ORDINAL_DIGITS) & ~F.coalesce(token_core(prev).isin(NUMBER_LABELS), F.lit(False))
    number_goes_on = number & (ordinal | nxt.isNull() | ~starts_sentence(nxt) | F.coalesce(token_core(nxt).isin(ORDINAL_FOLLOWERS), F.lit(False)))
    stop = bare.rlike(r"\.$") & (abbreviation | number_goes_on)
    full = F.coalesce(bare.rlike(r"[.!?…]$") & ~stop & (nxt.isNull() | starts_sentence(nxt)), F.lit(False))
    return F.when(cur.rlike(r"[.!?…]"), full).otherwise(False)  # most tokens have no mark at all


def boundaries(tokens: Column) -> Column:
    """array<boolean>: which tokens end a sentence. Neighbours come from shifted copies of the array, so each is evaluated once whatever expression ``tokens`` is."""
    none = F.array(F.lit(None).cast("string"))
    n = F.greatest(F.size(tokens) - 1, F.lit(0))
    before, after = F.concat(none, F.slice(tokens, 1, n)), F.concat(F.slice(tokens, 2, n), none)
    triples = F.zip_with(F.zip_with(before, tokens, lambda p, t: F.struct(p.alias("p"), t.alias("t"))), after, lambda x, y: F.struct(x["p"].alias("p"), x["t"].alias("t"), y.alias("n")))
    return F.when(F.size(tokens) > 0, F.transform(triples, lambda x: is_boundary(x["p"], x["t"], x["n"]))).otherwise(F.array().cast("array<boolean>"))


def sentence_spans(tokens: Column) -> Column:
    """array<struct<a,b>>: half-open token ranges of the sentences; a trailing rest is one too; an empty array has none."""
    n = F.size(tokens)
    ends = F.filter(F.transform(boundaries(tokens), lambda e, i: F.when(e, i + 1)), lambda x: x.isNotNull())
    ends = F.array_distinct(F.concat(ends, F.array(n)))
    spans = lambda e: F.zip_with(F.concat(F.array(F.lit(0)), F.slice(e, 1, F.size(e) - 1)), e, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.when(n > 0, let(ends, spans)).otherwise(F.array().cast("array<struct<a:int,b:int>>"))


def is_clitic(t: Column) -> Column:
    """Belongs to the token before: no letter or digit; one capital after a full stop; or an apostrophe or dash before a lower-case letter."""
    return ~t.rlike(r"[\p{L}\p{N}]") | t.rlike(r"^\s*\.\p{Lu}\.?\s*$") | t.rlike(r"^\s*['’\-–]\p{Ll}")
