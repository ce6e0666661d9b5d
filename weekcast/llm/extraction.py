"""HTML main-text extraction by consensus host paths.

1. Each page's containers are scored on their own, and the page votes for its
   best one's generalised tag-class path (long numbers and hash-like names
   become ``#``; a second, looser vote generalises every number).
2. Spark counts the votes by host. A path wins with two votes or more and a
   fiftieth of its host's pages.
3. Each page is read again and the text under its host's winning path extracted;
   a page that has none of them, or no host, is taken by its own best container.

Hosts are met by ``join_heavy``: pages of a host with a 1024th of all pages or
more are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekcast.llm.common import free_names, join_heavy, lean, save, ship
from weekcast.llm.pagetree import Page, choose

LEAST_VOTES = 2
SHARE = 50                      # a winner has at least this fraction (1 / SHARE) of its host's pages: at most so many win


def host(url: Column) -> Column:
    """Lower-case host of a URL; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^\s*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)", 1))


def _votes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        paths = [Page(h).best() for h in frame["html"]]
        yield pd.DataFrame({"host": frame["host"], "path": paths}).dropna(subset=["path"])


def winning_paths(pages: DataFrame) -> DataFrame:
    """(host, pages, strict, loose, votes) of every host of ``pages`` (host, html): winning paths, most voted first.

    ``strict`` and ``loose`` are lists of paths, ``votes`` those of ``strict``.
    Pages without a host vote for nothing.
    """
    votes = save(pages.filter("host != ''").mapInPandas(lean(_votes), "host string, path string").groupBy("host", "path").agg(F.count("*").alias("n")), "votes")
    sizes = save(pages.groupBy("host").agg(F.count("*").alias("pages")), "hosts")
    general = F.regexp_replace("path", r"\d+", "#")
    loose = votes.select("host", general.alias("path"), "n").groupBy("host", "path").agg(F.sum("n").alias("n"))
    every = save(votes.withColumn("loose", F.lit(False)).unionByName(loose.withColumn("loose", F.lit(True))).filter(F.col("n") >= LEAST_VOTES), "paths")
    won = join_heavy(every, sizes, ["host"], "pages").filter(F.col("n") * SHARE >= F.col("pages"))
    best = won.groupBy("host").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("less"), "path", "loose"))).alias("best"))
    strict = F.filter("best", lambda b: ~b["loose"])
    lists = best.select("host", F.transform(strict, lambda b: b["path"]).alias("strict"), F.transform(F.filter("best", lambda b: b["loose"]), lambda b: b["path"]).alias("loose"),
                        F.transform(strict, lambda b: -b["less"]).alias("votes"))
    return sizes.join(lists, "host", "left")


def _texts(html: pd.Series, strict: pd.Series, loose: pd.Series, votes: pd.Series) -> pd.Series:
    out = []
    for h, s, g, v in zip(html, strict, loose, votes, strict=True):
        page = Page(h)
        path = choose(page, [], [], {}) if s is None else choose(page, list(s), list(g), dict(zip(s, v, strict=True)))
        out.append(page.text(path) if path is not None else "")
    return pd.Series(out, dtype=object)


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` without html, with ``text`` (main text, blocks joined by one space) and ``n_chars`` (its code points).

    A null html counts as empty and gives an empty text; so does a page without
    text outside menus, headers, footers, sidebars, notices, adverts, forms,
    scripts, styles and reader comments. ``header`` elements are headers
    wherever they stand. A null or malformed url has no host. Repeated rows stay
    and vote each time. Other columns go along; an input column named text or
    n_chars is replaced. An empty table gives no rows.
    """
    ship(pages.sparkSession)
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    winners = save(winning_paths(pages.select(host(F.col("url")).alias("host"), html.alias("html"))), "winners")
    carried = [c for c in pages.columns if c not in ("html", "text", "n_chars")]
    at, strict, loose, votes, size = free_names(pages, "host", "strict", "loose", "votes", "pages")
    side = winners.select(F.col("host").alias(at), F.col("pages").alias(size), F.col("strict").alias(strict), F.col("loose").alias(loose), F.col("votes").alias(votes))
    rows = pages.select(*[F.col(f"`{c}`") for c in carried], html.alias("html"), host(F.col("url")).alias(at))
    met = join_heavy(rows, side, [at], size)
    texts = F.pandas_udf(_texts, "string")
    return (met.withColumn("text", texts("html", strict, loose, votes)).withColumn("n_chars", F.length("text").cast("long"))
            .select(*[F.col(f"`{c}`") for c in carried], "text", "n_chars"))
