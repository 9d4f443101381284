"""URL checks and keys. ``parse_url`` isn't used: it refuses hosts with an underscore and keeps the host's case."""

from __future__ import annotations

import ipaddress

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from .text import stripped

# Schemes, ports that are never visited, the longest URL, and playlist endings.
SCHEMES = ("http", "https")
BLOCKED_PORTS = (22, 23, 25, 445, 3306, 5432, 6379, 11211, 27017)
LONGEST = 2048
PLAYLISTS = ("m3u", "m3u8", "pls", "xspf", "asx")

SHAPE = r"^([A-Za-z][A-Za-z0-9+.\-]*):(?://([^/?#]*))?([^?#]*)"


def let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, SHAPE, 1))


def authority(url: Column) -> Column:
    return F.regexp_extract(url, SHAPE, 2)


def host(url: Column) -> Column:
    """Lower case, without user, port and the brackets of an IPv6 address."""
    bare = F.regexp_replace(authority(url), "^.*@", "")
    six = F.regexp_extract(bare, r"^\[([^\]]*)\]", 1)
    return F.lower(F.when(bare.startswith("["), six).otherwise(F.regexp_extract(bare, "^([^:]*)", 1)))


def port_text(url: Column) -> Column:
    return F.regexp_extract(F.regexp_replace(authority(url), "^.*@", ""), r":([^:\]]*)$", 1)


def port(url: Column) -> Column:
    """The port as written; null if there is none or it is no number."""
    return port_text(url).try_cast("int")


def path(url: Column) -> Column:
    return F.regexp_extract(url, SHAPE, 3)


@F.pandas_udf(BooleanType())
def _public_six(address: pd.Series) -> pd.Series:
    def public(x):
        try:
            a = ipaddress.ip_address(x)
        except ValueError:
            return None
        return not (a.is_private or a.is_loopback or a.is_link_local or a.is_multicast or a.is_reserved or a.is_unspecified)

    return address.map(public, na_action="ignore")


# IPv4 networks that aren't public, and single addresses in them that are.
PRIVATE = "0.0.0.0/8 10.0.0.0/8 127.0.0.0/8 169.254.0.0/16 172.16.0.0/12 192.0.0.0/24 192.0.2.0/24 192.168.0.0/16 198.18.0.0/15 198.51.100.0/24 203.0.113.0/24 224.0.0.0/4 240.0.0.0/4".split()
PUBLIC_WITHIN = ("192.0.0.9", "192.0.0.10")


_RANGES = [(int(n.network_address), int(n.broadcast_address)) for n in map(ipaddress.ip_network, PRIVATE)]


def is_public_ipv4(address: Column) -> Column:
    """True or false for an IPv4 literal, null for anything else."""

    def of(octets: Column) -> Column:
        fine = (F.size(octets) == 4) & F.forall(octets, lambda o: F.coalesce(o < 256, F.lit(False)))
        return F.when(fine, let(F.aggregate(octets, F.lit(0).cast("bigint"), lambda n, o: n * 256 + o), number))

    def number(value: Column) -> Column:
        inside = F.exists(F.array(*(F.struct(F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for lo, hi in _RANGES)), lambda r: value.between(r["lo"], r["hi"]))
        return ~inside | address.isin(*PUBLIC_WITHIN)

    # one pattern, then numbers: what is no literal costs no more than the test
    literal = address.rlike(r"^(?:0|[1-9]\d{0,2})(?:\.(?:0|[1-9]\d{0,2})){3}$")
    return F.when(literal, let(F.transform(F.split(address, r"\."), lambda o: o.cast("bigint")), of))


def is_public(address: Column) -> Column:
    """Of any IP literal; IPv6 is left to a pandas UDF."""
    return F.coalesce(is_public_ipv4(address), _public_six(F.when(address.contains(":"), address)))


def refusal(url: Column, six: bool = False) -> Column:
    """Why a URL is unsafe, null if its shape is fine. ``six`` also checks IPv6 literals."""
    url = F.coalesce(url, F.lit(""))
    trimmed = F.trim(url)

    def of(u: Column) -> Column:
        number = F.coalesce(F.nullif(u["port"], F.lit(0)), F.when(u["scheme"] == "https", 443).otherwise(80))
        return (
            F.when((u["url"] == "") | (F.length(u["url"]) > LONGEST), "length")
            .when(~u["scheme"].isin(*SCHEMES), "scheme")
            .when(u["host"] == "", "host")
            .when((u["port_text"] != "") & u["port"].isNull(), "port")
            .when(number.isin(*BLOCKED_PORTS) | (number < 1) | (number > 65535), "port")
            .when(~is_public_ipv4(u["host"]), "address")
        )

    # each part is taken once
    reason = let(F.struct(url.alias("url"), scheme(trimmed).alias("scheme"), host(trimmed).alias("host"), port_text(trimmed).alias("port_text"), port(trimmed).alias("port")), of)
    if not six:
        return reason
    named = host(trimmed)
    return F.coalesce(reason, F.when(~_public_six(F.when(named.contains(":"), named)), "address"))


def dedup_key(url: Column) -> Column:
    """One key for the ways to write a stream's URL: no scheme, www, usual port, query, trailing slashes."""
    number = F.nullif(port(url), F.lit(0))
    shown = F.when(number.isNotNull() & ~number.isin(80, 443), F.concat(F.lit(":"), number.cast("string"))).otherwise("")
    address = F.concat(F.regexp_replace(host(url), r"^www\.", ""), shown)
    rest = F.regexp_replace(path(url), "/+$", "")
    return F.when((address == "") & ~rest.startswith("//"), rest).otherwise(F.concat(F.lit("//"), address, rest))


def status_base(url: Column) -> Column:
    number = F.nullif(port(url), F.lit(0))
    return F.when(refusal(url).isNull(), F.concat(scheme(url), F.lit("://"), host(url), F.coalesce(F.concat(F.lit(":"), number.cast("string")), F.lit(""))))


def _path_of(text: Column) -> Column:
    return F.when(text.contains("//"), F.regexp_extract(text, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)).otherwise(text)


def mount_path(text: Column) -> Column:
    """A mount for comparison: lower case, without query, semicolons, playlist ending, trailing slashes."""
    out = F.lower(stripped(F.regexp_extract(F.coalesce(F.nullif(_path_of(text), F.lit("")), F.lit("/")), r"^([^?]*)", 1)))
    out = F.regexp_replace(out, ";+$", "")
    for ending in PLAYLISTS:
        out = F.regexp_replace(out, rf"\.{ending}$", "")
    out = F.when(out.startswith("/"), out).otherwise(F.concat(F.lit("/"), out))
    return F.coalesce(F.nullif(F.regexp_replace(out, "/+$", ""), F.lit("")), F.lit("/"))


def raw_mount_path(text: Column) -> Column:
    out = stripped(F.regexp_extract(_path_of(text), r"^([^?]*)", 1))
    return F.when((out == "") | out.startswith("/"), out).otherwise(F.concat(F.lit("/"), out))


def codec_of(content_type: Column) -> Column:
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    return F.when(kind.contains("aac"), "AAC").when(kind.rlike("mpeg|mp3"), "MP3").when(kind.rlike("ogg|vorbis"), "OGG").when(kind.contains("flac"), "FLAC").otherwise("")
