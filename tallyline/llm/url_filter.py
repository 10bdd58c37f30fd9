"""URL verdicts by listed hosts and path beginnings: a blocked Bloom filter, then an exact hash join.

A listed entry (host, path beginning) has the canonical key ``host + path``. A URL's keys are all
suffixes of its host at a dot, the whole host too, with its path cut to each length that an entry's
path has. The filter lets a few percent of unlisted keys pass at most while the list fits in its size;
the join on the key removes every false hit, so the result is exact for any list. Only keys that pass
are exchanged. Of the entries that fit a URL the one with the longest key wins.

Host and path are empty for a null URL and for one without ``://``; such a URL fits no entry, and
neither does one whose path is empty unless an entry's path is. Rows are judged one by one: repeated
rows and null keys stay. Entries with a null part are ignored; of equal keys with different verdicts
block wins.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm import bloom
from tallyline.llm.store import fresh, staged


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge_urls(pages: DataFrame, listed: DataFrame, otherwise: str = "allow", url_col: str = "url") -> DataFrame:
    """``pages`` with host, path, rule and verdict of each URL; columns of those names are replaced.

    ``listed``: (host, path, verdict) entries. rule: the entry's host and path, null if none fits.
    """
    entries = listed.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL").groupBy(
        F.concat("host", "path").alias("_key"), F.length("path").alias("_size")).agg(F.max("verdict").alias("_verdict"))
    entries = staged(entries.groupBy("_key").agg(F.max("_verdict").alias("_verdict"), F.collect_set("_size").alias("_sizes")),
                     "url-entries")
    table = bloom.build(entries.select(F.xxhash64("_key").alias("hash")))
    # Distinct path lengths: no more than the longest path of an entry has letters.
    sizes = [r[0] for r in entries.select(F.explode("_sizes").alias("size")).distinct().orderBy("size").collect()]

    @F.pandas_udf(T.ArrayType(T.BooleanType()))
    def may_be_listed(hashes: pd.Series) -> pd.Series:
        counts = hashes.map(len).to_numpy()
        flat = np.concatenate([*hashes, np.empty(0, np.int64)]).astype(np.int64)
        return pd.Series(np.split(bloom.may_hold(table, flat), np.cumsum(counts)[:-1]), index=hashes.index)

    pages = pages.drop("host", "path", "rule", "verdict")
    judged = pages.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
    labels = F.split("host", r"\.")
    n = F.size(labels)
    ends = F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))
    fitting = F.filter(F.array(*[F.lit(s) for s in sizes]).cast("array<int>"), lambda s: s <= F.length("path"))
    keys = F.flatten(F.transform(ends, lambda end: F.transform(fitting, lambda s: F.concat(end, F.substring(F.col("path"), F.lit(1), s)))))
    # Pages with the same host and path get the same verdict: each such pair is looked up once.
    places = judged.select("host", "path").where("host <> ''").distinct().withColumn("_keys", keys)
    places = places.withColumn("_pass", may_be_listed(F.transform("_keys", lambda k: F.xxhash64(k))))
    passed = F.filter(F.arrays_zip("_keys", "_pass"), lambda x: x["_pass"])
    hits = places.select("host", "path", F.explode(passed).alias("_hit")).select("host", "path", F.col("_hit._keys").alias("_key"))
    found = hits.join(entries.select("_key", "_verdict"), "_key").groupBy("host", "path").agg(
        F.max(F.struct(F.length("_key").alias("n"), F.col("_key").alias("rule"), F.col("_verdict").alias("verdict"))).alias("_best"))
    h, p, best = fresh("host"), fresh("path"), fresh("best")
    found = found.select(F.col("host").alias(h), F.col("path").alias(p), F.col("_best").alias(best))
    joined = judged.join(found, (judged["host"] == found[h]) & (judged["path"] == found[p]), "left")
    return joined.select(*[joined[f"`{c}`"] for c in pages.columns], "host", "path", F.col(f"{best}.rule").alias("rule"),
                         F.coalesce(f"{best}.verdict", F.lit(otherwise)).alias("verdict"))
