"""Folding of names and titles. Three foldings differ on purpose: decomposition and what counts as a mark."""

from __future__ import annotations

import html
import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

# Separators, edge characters, junk titles and broken encodings.
SPACE = r"[\s\x1c-\x1f]"
SEPARATOR = r"(?U)\s+[-–—]\s+"
EDGE = " -–—\"'"
JUNK = r"(?iu)^unknown artist|^unknown$|^\s*-\s*$|^advert|^reklama|^werbung|^commercial|^jingle|^id\s*$|^station id|^live stream|^untitled|^no title|^\d+\s*$"
MOJIBAKE = "[\u0080-\u009f]|[ÃÂÅÐÑ][A-Z]|Ã[¡-ÿ]|Å[¡¾]"
WORD = r"(?U)[\p{L}]{2,}"
BRACKETED = r"(?d)[\(\[].*?[\)\]]"
COLLABORATORS = r"(?U)\s+(?:feat\.?|ft\.?|featuring|vs\.?|&|with)\s+"


@cache
def _marks(by_class: bool) -> str:
    """A character class of combining marks: by combining class, or by category Mn."""
    points = [i for i in range(0x300, 0x110000) if (unicodedata.combining(chr(i)) if by_class else unicodedata.category(chr(i)) == "Mn")]
    out, start = [], None
    for i, j in zip(points, [*points[1:], -1]):
        start = i if start is None else start
        if j != i + 1:
            out.append(f"\\x{{{start:X}}}-\\x{{{i:X}}}")
            start = None
    return "[" + "".join(out) + "]+"


def stripped(text: Column) -> Column:
    """Without white space at either end, of any kind."""
    return F.regexp_replace(text, rf"(?U)^{SPACE}+|{SPACE}+\z", "")


def without_marks(text: Column, form: str, by_class: bool) -> Column:
    """The text decomposed (NFD or NFKD), without combining marks."""

    @F.arrow_udf(StringType())
    def strip(values):
        import pyarrow.compute as pc

        return pc.replace_substring_regex(pc.utf8_normalize(values, form=form), pattern=_marks(by_class), replacement="")

    return strip(text)


def _plain(text: Column) -> Column:
    """Letters a-z, digits and single spaces, without a leading article."""
    text = F.regexp_replace(F.regexp_replace(text, BRACKETED, " "), "[^a-z0-9 ]+", " ")
    return F.regexp_replace(F.trim(F.regexp_replace(text, " +", " ")), "^the ", "")


def fold(text: Column) -> Column:
    """The key of a name or title in the lexicon."""
    return _plain(without_marks(F.lower(text), "NFD", by_class=False))


def artist_key(text: Column) -> Column:
    """The key of an artist: without collaborators, brackets, article."""
    bare = without_marks(F.lower(text), "NFKD", by_class=True)
    return _plain(F.split(bare, COLLABORATORS, 2)[0])


def tag_key(text: Column) -> Column:
    """A tag for the taxonomy: separators become spaces."""
    bare = without_marks(F.lower(stripped(text)), "NFKD", by_class=True)
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"[_\-/|]+", " "), r"(?U)\s+", " "))


def song_key(artist: Column, track: Column) -> Column:
    """Both halves of a song, kept apart by a zero character."""
    bare = without_marks(F.lower(F.concat(artist, F.lit("\0"), track)), "NFKD", by_class=True)
    return F.trim(F.regexp_replace(F.regexp_replace(bare, "[^a-z0-9\\x00]+", " "), " +", " "))


@F.pandas_udf(StringType())
def unescaped(text: pd.Series) -> pd.Series:
    """Character references decoded; Spark has no function for them."""
    return text.map(html.unescape, na_action="ignore")


def key64(text: Column) -> Column:
    """A stable 64-bit key: the first 8 bytes of BLAKE2b of that length, as a signed number; Spark has no function for it."""

    @F.arrow_udf(LongType())
    def keyed(values):
        import hashlib

        import pyarrow as pa

        digest = lambda v: int.from_bytes(hashlib.blake2b(v.encode(), digest_size=8).digest(), "big", signed=True)
        return pa.array([None if v is None else digest(v) for v in values.to_pylist()], pa.int64())

    return keyed(text)


def spaced(text: Column) -> Column:
    """White space collapsed and trimmed."""
    return F.trim(F.regexp_replace(text, rf"(?U){SPACE}+", " "))


def is_junk(text: Column) -> Column:
    return text.rlike(JUNK)


def is_broken(text: Column) -> Column:
    return text.rlike(MOJIBAKE)


def halves(text: Column, left: int = 120, right: int = 120) -> Column:
    """(left, right) of the first spaced dash, null unless both are there and no longer than allowed."""
    parts = F.split(text, SEPARATOR, 2)
    a, b = F.btrim(F.get(parts, F.lit(0)), F.lit(EDGE)), F.btrim(F.get(parts, F.lit(1)), F.lit(EDGE))
    good = (F.size(parts) == 2) & (a != "") & (b != "") & (F.length(a) <= left) & (F.length(b) <= right)
    return F.when(good, F.struct(a.alias("left"), b.alias("right")))


def song_of(raw: Column) -> Column:
    """(artist, track) of a raw title, null when it isn't a song."""
    text = spaced(raw)
    pair = halves(text, 90, 120)
    song = F.struct(pair["left"].alias("artist"), pair["right"].alias("track"))
    good = (F.length(text) >= 4) & ~is_junk(text) & ~is_broken(text) & pair.isNotNull()
    return F.when(good & pair["left"].rlike(WORD) & ~is_junk(pair["left"]) & ~is_junk(pair["right"]), song)
