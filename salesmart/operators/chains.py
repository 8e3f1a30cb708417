"""Order of landed pages in the chains that their next-page tokens make.

A page is fetched by a token (the first of its list by none) and names the
token of the page after it (the last names none).  ``page_chains`` puts every
page at its place and tells what is missing: a page that was never landed, a
token that leads back, a list that was begun in the middle.

Places are found by pointer doubling: every page knows the page ``2**k`` places
before it and how far that is, and one join per round doubles the distance, so a
chain of a million pages takes twenty rounds and no page list is ever walked
or gathered.  Each round lands its table; a lost executor repeats one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.session import own_path


def _landed(df: DataFrame, name: str) -> DataFrame:
    path = own_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def chain_ranks(links: DataFrame) -> DataFrame:
    """``(id, chain, position, looped)`` of linked rows ``(id, prev)``.

    ``prev`` is the id before a row, null for the first; no two rows may have
    the same ``prev``, and each ``prev`` must be an id.  ``chain`` is the id of
    the first row and ``position`` counts from 1.  Rows that lie on a ring have
    no first row: there the smallest id is taken as first and ``looped`` is true.
    """
    state = _landed(
        links.select(
            "id",
            F.coalesce("prev", "id").alias("to"),
            F.when(F.col("prev").isNull(), 0).otherwise(1).cast("bigint").alias("far"),
            F.col("prev").isNull().alias("done"),
        ),
        "chain",
    )
    state = _doubled(state)
    placed = state.where("done").select("id", F.col("to").alias("chain"), (F.col("far") + 1).alias("position"), F.lit(False).alias("looped"))
    rings = state.where("not done").select("id")
    if rings.isEmpty():
        return placed
    ring_links = _landed(links.join(rings, "id", "left_semi").select("id", "prev"), "rings")
    smallest = _ring_smallest(ring_links)
    first = F.col("id") == F.col("least")
    cut = ring_links.join(smallest, "id").select("id", F.when(~first, F.col("prev")).alias("prev"))
    rest = chain_ranks(cut).withColumn("looped", F.lit(True))
    return placed.unionByName(rest)


def _doubled(state: DataFrame) -> DataFrame:
    """Rounds until every row of a chain with a first row is done; what is left lies on rings.

    All rows within ``2**k`` of their first row are done after round k, so a
    round that ends none leaves only rings.
    """
    left = state.where("not done").count()
    while left:
        target = state.select(F.col("id").alias("t"), F.col("to").alias("t_to"), F.col("far").alias("t_far"), F.col("done").alias("t_done"))
        moved = (
            state.where("not done")
            .join(target, F.col("to") == F.col("t"))
            .select("id", F.col("t_to").alias("to"), (F.col("far") + F.col("t_far")).alias("far"), F.col("t_done").alias("done"))
        )
        state = _landed(state.where("done").unionByName(moved), "chain")
        now = state.where("not done").count()
        if now == left:
            break
        left = now
    return state


def _ring_smallest(ring: DataFrame) -> DataFrame:
    """``(id, least)``: the smallest id of every row's ring.

    The minimum over ``2**k`` rows doubles its reach each round; once no row's
    minimum changes it is the ring's.
    """
    state = _landed(ring.select("id", F.col("prev").alias("to"), F.col("id").alias("least")), "ring")
    while True:
        target = state.select(F.col("id").alias("t"), F.col("to").alias("t_to"), F.col("least").alias("t_least"))
        moved = state.join(target, F.col("to") == F.col("t")).select(
            "id",
            F.col("t_to").alias("to"),
            F.least("least", "t_least").alias("least"),
            (F.col("t_least") < F.col("least")).alias("changed"),
        )
        moved = _landed(moved, "ring")
        state = moved.drop("changed")
        if moved.where("changed").isEmpty():
            return state.select("id", "least")


def page_chains(pages: DataFrame, page_id: str, list_id: str, token: str, next_token: str) -> DataFrame:
    """``pages`` with chain, position, status and is_complete.

    ``page_id`` is unique and grows with the landing.  A token that was landed
    several times within a list counts once: the last landing replaces the
    others (status ``replaced``, no chain).  Where several pages name the same
    next page, it follows the one with the smallest id; the others' chains end
    there.  An empty token reads as none, and pages of a null list are a list of
    their own.  ``chain`` is the page id of a chain's first page; ``status`` is
    the chain's:

    - ``complete``: from the list's first page to a page that names no next one;
    - ``no_start``: it begins with a page that no landed page leads to;
    - ``break``: its last page names a page that was never landed;
    - ``joined``: its last page names a page of another chain;
    - ``loop``: its last page names a page of the same chain, or it is a ring.

    Of several, the last in this list is told.  Other columns stay as they are.
    """
    own = F.coalesce(F.col(list_id).cast("string"), F.lit("")).alias("list"), F.col(list_id).isNull().alias("no_list")

    def filled(c: str):
        return F.when(F.col(c) != "", F.col(c))

    rows = pages.select(F.col(page_id).alias("id"), *own, F.coalesce(filled(token), F.lit("")).alias("token"), filled(next_token).alias("next"))
    where = ["list", "no_list", "token"]
    last = rows.groupBy(*where).agg(F.max_by(F.struct("id", "next"), F.col("id")).alias("page"))
    nodes = _landed(last.select(*where, "page.id", "page.next"), "pages")
    # The page that a page names, and the first to name it.
    named = nodes.where("next is not null").select("list", "no_list", F.col("id").alias("prev"), F.col("next").alias("token"))
    claims = named.groupBy(*where).agg(F.min("prev").alias("prev"))
    links = _landed(nodes.join(claims, where, "left").select(*where, "id", "prev", "next"), "links")
    ranks = _landed(chain_ranks(links.select("id", "prev")), "ranks")
    placed = links.join(ranks, "id")
    follower = placed.select("list", "no_list", F.col("token").alias("next"), F.col("id").alias("next_id"), F.col("chain").alias("next_chain"), F.col("prev").alias("next_prev"))
    ended = placed.join(follower, ["list", "no_list", "next"], "left")
    claimed = F.col("next_prev") == F.col("id")
    end = (
        F.when(F.col("looped") | (~claimed & (F.col("next_chain") == F.col("chain"))), 4)
        .when(~claimed, 3)
        .when(F.col("next").isNotNull() & F.col("next_id").isNull(), 2)
        .when((F.col("position") == 1) & (F.col("token") != ""), 1)
        .otherwise(0)
    )
    names = F.array(*[F.lit(s) for s in ("complete", "no_start", "break", "joined", "loop")])
    chains = ended.groupBy("chain").agg(F.max(end).alias("worst")).select("chain", F.get(names, F.col("worst")).alias("status"))
    found = _salted(ranks.select("id", "chain", "position"), chains)
    out = pages.join(found.withColumnRenamed("id", page_id), page_id, "left").withColumn("status", F.coalesce("status", F.lit("replaced")))
    return out.withColumn("is_complete", F.col("status") == "complete")


def _salted(ranks: DataFrame, chains: DataFrame) -> DataFrame:
    """Every page with its chain's status; a long chain's pages are joined in runs of positions."""
    run = F.floor(F.col("position") / 100_000).alias("run")
    runs = ranks.select("chain", run).distinct().join(chains, "chain")
    return ranks.withColumn("run", run).join(runs, ["chain", "run"]).drop("run")
