"""Chains of stored response pages: follow each page's next token to the end.

A page is known by its listing and its own token (the first page of a listing
may have a null token) and names the next page's token, null on the last one. Links are
followed by pointer doubling: each round joins every unfinished page with the
page its pointer has come to, so a chain of n pages takes about log2(n) rounds
whatever its length, and no chain is gathered in one task. Each round's table is stored,
so a lost executor costs one round.

Cases: a page stored several times counts once and as repeated (its next token
is the smallest given, null only if all are); a null listing is a listing of its own; a
page that names itself, or any loop, is reported as a loop; no pages, no chains.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.session import scratch_path

FIRST = ""  # a null token, and no token of an answer


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "page_chains")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def follow(pages: DataFrame, listing: str = "listing", token: str = "token", next_token: str = "next_token") -> DataFrame:
    """One row per distinct page: key (listing and token), ``ptr`` (null at an
    end; otherwise the page runs into a loop), ``n_pages`` and ``n_repeated``
    from this page to the end, ``missing`` (the token asked for that is
    not stored) and ``low`` (the smallest token on the way)."""
    name = lambda t: F.struct(F.col(listing).cast("string").alias("listing"), t.alias("token"))
    one = (pages.groupBy(F.col(listing).cast("string").alias(listing), F.coalesce(F.col(token).cast("string"), F.lit(FIRST)).alias("own"))
           .agg(F.min(F.col(next_token).cast("string")).alias("next"), F.count(F.lit(1)).alias("copies")))
    state = _stored(one.select(
        name(F.col("own")).alias("page"), F.when(F.col("next").isNotNull(), name(F.col("next"))).alias("ptr"),
        F.lit(1).cast("long").alias("n_pages"), (F.col("copies") > 1).cast("long").alias("n_repeated"),
        F.lit(None).cast("string").alias("missing"), F.col("own").alias("low")))
    n, reach = state.count(), 1
    while reach < n and not state.filter(F.col("ptr").isNotNull()).isEmpty():
        ahead = state.select(*[F.col(c).alias(f"to_{c}") for c in state.columns])
        # finished pages stay out of the join: they would all meet under the null pointer
        met = state.filter(F.col("ptr").isNotNull()).join(ahead, F.col("ptr").eqNullSafe(F.col("to_page")), "left")
        found = F.col("to_page").isNotNull()
        moved = met.select(
            "page", "to_ptr", (F.col("n_pages") + F.coalesce("to_n_pages", F.lit(0))),
            (F.col("n_repeated") + F.coalesce("to_n_repeated", F.lit(0))),
            F.when(found, F.col("to_missing")).otherwise(F.col("ptr.token")), F.least("low", "to_low"))
        state = _stored(moved.toDF(*state.columns).union(state.filter(F.col("ptr").isNull())))
        reach *= 2
    return state


def chains(pages: DataFrame, listing: str = "listing", token: str = "token", next_token: str = "next_token") -> DataFrame:
    """One row per chain: listing, head (the token no page names), n_pages,
    n_repeated, missing (null: the chain is whole), loops. Of a chain that runs into a loop only
    the head is told (counts null); the loop itself is one more row, headed by its smallest token."""
    state = follow(pages, listing, token, next_token)
    linked = _stored(pages.filter(F.col(next_token).isNotNull()).select(F.struct(
        F.col(listing).cast("string").alias("listing"), F.col(next_token).cast("string").alias("token")).alias("page")).distinct())
    row = lambda df, n, r, loops: df.select(
        F.col("page.listing").alias("listing"), F.col("page.token").alias("head"), n.alias("n_pages"), r.alias("n_repeated"),
        "missing", F.lit(loops).alias("loops"))
    heads = state.join(linked.withColumnRenamed("page", "named"), F.col("page").eqNullSafe(F.col("named")), "left_anti")
    whole = row(heads.filter(F.col("ptr").isNull()), F.col("n_pages"), F.col("n_repeated"), False)
    none = F.lit(None).cast("long")
    into = row(heads.filter(F.col("ptr").isNotNull()), none, none, True)
    # far enough on, pointers stand on loops only, and on every page of them
    left = state.filter(F.col("ptr").isNotNull())
    on = left.select(F.col("ptr").alias("at")).distinct()
    ring = (left.join(on, F.col("page").eqNullSafe(F.col("at")), "left_semi")
            .groupBy(F.struct(F.col("page.listing").alias("listing"), F.col("low").alias("token")).alias("page"))
            .agg(F.count(F.lit(1)).alias("n")))
    loops = row(ring.withColumn("missing", F.lit(None).cast("string")), F.col("n"), none, True)
    return whole.unionByName(into).unionByName(loops)
