"""URLs whose host resolves to public addresses only; names are resolved once for each host."""

from __future__ import annotations

import socket
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import url as U


def resolved(hosts: DataFrame, host: str = "host") -> DataFrame:
    """(host, address) by the executors' resolvers; a host that doesn't resolve has no row."""

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name in batch[host]:
                try:
                    rows += [(name, a) for a in sorted({info[4][0] for info in socket.getaddrinfo(name, None, proto=socket.IPPROTO_TCP)})]
                except OSError:
                    continue
            yield pd.DataFrame(rows, columns=["host", "address"])

    return hosts.select(host).distinct().mapInPandas(look_up, "host string, address string")


def verdicts(urls: DataFrame, addresses: DataFrame, url: str = "url") -> DataFrame:
    """``urls`` with host and unsafe: why the URL is refused, null if all addresses of its host are public.

    One address that isn't public refuses the host, so that none can be tried in its stead later.
    """
    judged = addresses.groupBy("host").agg(F.bool_and(F.coalesce(U.is_public(F.col("address")), F.lit(False))).alias("public"))
    named = urls.withColumn("host", U.host(F.col(url))).withColumn("shape", U.refusal(F.col(url), six=True))
    unsafe = F.coalesce("shape", F.when(F.col("public").isNull(), "unresolved").when(~F.col("public"), "address"))
    return named.join(judged, "host", "left").withColumn("unsafe", unsafe).drop("public", "shape")
