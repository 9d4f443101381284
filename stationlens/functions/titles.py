"""Which half of a title is the artist: structural cues and the order in which evidence counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ARTIST_FIRST, TRACK_FIRST = 0, 1

# Words that mark a version of a track, and words that join performers.
VERSIONS = (
    "mix", "remix", "edit", "version", "live", "acoustic", "instrumental", "radio", "remaster", "remastered", "cover", "prod", "feat", "ft", "featuring", "extended", "club", "original", "single", "album", "demo", "bonus", "explicit", "clean", "mono", "stereo", "reprise", "intro", "outro", "part", "pt", "vocal", "dub",
)
VERSION = rf"(?iuU)[\(\[][^\)\]]*\b({'|'.join(VERSIONS)})\b"
COLLABORATION = r"(?iuU)(?<![\(\[])\b(feat\.?|ft\.?|featuring|vs\.?|pres\.?|presents)\b(?![^\(\[]*[\)\]])"


def structural(left: Column, right: Column) -> Column:
    """(orientation, bound); orientation is null without a cue.

    A cue is bound if it can't be an annotation of the whole line: in the left half
    always, in the right half if its brackets close before the end.
    """
    in_left, in_right = left.rlike(VERSION), right.rlike(VERSION)
    joins_left, joins_right = left.rlike(COLLABORATION), right.rlike(COLLABORATION)
    closes = F.rtrim(right).rlike(VERSION + r"[^\)\]]*[\)\]].")
    cue = lambda o, bound: F.struct(F.lit(o).cast("int").alias("orientation"), bound.alias("bound"))
    yes, no = F.lit(True), F.lit(False)
    return (
        F.when(in_right & ~in_left, cue(ARTIST_FIRST, closes))
        .when(in_left & ~in_right, cue(TRACK_FIRST, yes))
        .when(joins_left & ~joins_right, cue(ARTIST_FIRST, yes))
        .when(joins_right & ~joins_left, cue(TRACK_FIRST, no))
        .otherwise(cue(None, no))
    )


def evidence(pair_lr: Column, pair_rl: Column, name_l: Column, name_r: Column, cue: Column, bound_decides: bool = True) -> Column:
    """(orientation, strength, source): a known pair, then a known name, then a cue."""
    found = lambda o, strength, source: F.struct(o.cast("int").alias("orientation"), F.lit(strength).cast("int").alias("strength"), F.lit(source).alias("source"))
    first, second = F.lit(ARTIST_FIRST), F.lit(TRACK_FIRST)
    return (
        F.when(pair_lr & ~pair_rl, found(first, 3, "pair"))
        .when(pair_rl & ~pair_lr, found(second, 3, "pair"))
        .when(name_l & ~name_r, found(first, 2, "name"))
        .when(name_r & ~name_l, found(second, 2, "name"))
        .when(cue["orientation"].isNull(), found(F.lit(None), 0, "none"))
        .when(cue["bound"], found(cue["orientation"], 2 if bound_decides else 1, "bound"))
        .otherwise(found(cue["orientation"], 1, "trailing"))
    )


# Endings of mount names that describe quality or delivery.
AUDIO = r"\.(mp3|aac|aacp|ogg|oga|opus|flac|m4a|nsv)$"
BITRATE = r"[_-]?(32|48|56|64|96|112|128|160|192|224|256|320)$"
DELIVERY = r"[_-](alexa|app|web|tunein|mobile|player|site|hd|sd|hi|lo|high|low|aac|mp3|ogg|flac|opus)$"


def station_stem(path: Column) -> Column:
    """A mount's name without up to three layers of delivery and bitrate endings."""
    stem = F.regexp_replace(F.regexp_replace(F.lower(path), "^/+", ""), AUDIO, "")
    for _ in range(3):
        stem = F.coalesce(F.nullif(F.regexp_replace(F.regexp_replace(stem, DELIVERY, ""), BITRATE, ""), F.lit("")), stem)
    return F.coalesce(F.nullif(stem, F.lit("")), F.lower(path))
