"""URL filter: explicit rules, then a path-template tree judged by labelled purity.

Rules decide the URLs they fit and label them.  For every host the paths form a
tree of templates: runs of digits become ``{n}``, and level by level a segment
turns into the wildcard ``*`` when it is rare under its parent, or when the
share of blocked URLs below it does not differ significantly from its
parent's, so that similar branches merge.  A template's purity is the share of
its URLs that rules block, smoothed towards its parent's purity at each level;
URLs without a rule are blocked when their template's purity is over one half.

Only DataFrame functions are used.  The URLs are first counted by host and typed
path with map-side combination, the tree is built from these counts, and the
verdicts return to the rows through (path, lane) keys, so a host with a third
of all URLs is spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import land, lane, shuffle_width

LEVELS = 3  # segments deeper than this count as part of the last


@dataclass(frozen=True)
class Rule:
    """``host`` (with all subdomains) and the start of the path; ``verdict`` is block or allow."""

    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


@dataclass(frozen=True)
class Tree:
    min_count: int = 5  # rarer segments are wildcards,
    min_share: float = 0.01  # as are those with a smaller share of their parent
    z: float = 2.0  # standard errors from which a branch differs from its parent
    weight: float = 10.0  # of the parent's purity, in URLs
    limit: float = 0.5  # purity over which a template is blocked


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def ruled(host: Column, path: Column, rules: Sequence[Rule], value: str) -> Column:
    """``rule`` or ``verdict`` of the longest rule that fits; null where none does."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(str(r))):  # the longest is asked first
        out = F.when(r.fits(host, path), F.lit(str(r) if value == "rule" else r.verdict)).otherwise(out)
    return out


def typed_segments(path: Column) -> list[Column]:
    """The first ``LEVELS`` segments, each with its slash and with digits generalised; the last holds the rest, those beyond the path's end are empty."""
    typed = F.regexp_replace(path, "[0-9]+", "{n}")
    pattern = "(?s)^" + "(/[^/]*)?" * (LEVELS - 1) + "(.*)$"
    return [F.regexp_extract(typed, pattern, k) for k in range(1, LEVELS + 1)]


def template_purity(counts: DataFrame, tree: Tree) -> DataFrame:
    """``counts`` (host, s1.., n, b: URLs and blocked ones) with the purity of each row's template."""
    hosts = counts.groupBy("host").agg(F.sum("n").alias("n0"), F.sum("b").alias("b0"))
    rows = counts.join(hosts, "host").withColumn("q", (F.col("b0") + tree.weight * 0.5) / (F.col("n0") + tree.weight))
    prefix = ["host"]
    for level in range(1, LEVELS + 1):
        seg, gen = f"s{level}", f"g{level}"
        child = rows.groupBy(*prefix, seg).agg(F.sum("n").alias("cn"), F.sum("b").alias("cb"))
        above = child.groupBy(*prefix).agg(F.sum("cn").alias("pn"), F.sum("cb").alias("pb"))
        child = child.join(above, prefix)
        rate = F.col("pb") / F.col("pn")
        error = F.sqrt(rate * (1 - rate) / F.col("cn"))
        rare = (F.col("cn") < tree.min_count) | (F.col("cn") < tree.min_share * F.col("pn"))
        alike = F.abs(F.col("cb") / F.col("cn") - rate) <= tree.z * error
        child = child.withColumn(gen, F.when(rare | alike, F.lit("/*")).otherwise(F.col(seg)))
        rows = rows.join(child.select(*prefix, seg, gen), [*prefix, seg])
        prefix = [*prefix, gen]
        merged = child.groupBy(*prefix).agg(F.sum("cn").alias("tn"), F.sum("cb").alias("tb"))
        rows = rows.join(merged, prefix)
        # Landed, as the next level reads the rows twice.
        rows = land(rows.withColumn("q", (F.col("tb") + tree.weight * F.col("q")) / (F.col("tn") + tree.weight)).drop("tn", "tb"), f"templates{level}")
    return rows.select("host", *[f"s{k}" for k in range(1, LEVELS + 1)], "q")


def judge_urls(df: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url_col: str = "url", tree: Tree = Tree()) -> DataFrame:
    """One row per row of ``df``: id, host, path, rule and verdict (block or allow).

    A null URL or one without ``://`` has an empty host and path; all such rows
    form one host, which no rule fits.  URLs of any length are judged; of rules
    of equal length the first holds.  Repeated rows are judged alike and all
    returned, null ids too; other columns are not read; an empty table gives an
    empty result.
    """
    segments = [f"s{k}" for k in range(1, LEVELS + 1)]
    rows = df.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    host, path = F.col("host"), F.col("path")
    rows = rows.select(
        id_col,
        "host",
        "path",
        ruled(host, path, rules, "rule").alias("rule"),
        ruled(host, path, rules, "verdict").alias("said"),
        *[s.alias(n) for s, n in zip(typed_segments(path), segments, strict=True)],
        lane(F.col(id_col), shuffle_width(df.sparkSession)).alias("lane"),
    )
    key = ["host", *segments]
    blocked = F.count(F.when(F.col("said") == "block", 1))
    in_lane = land(rows.groupBy(*key, "lane").agg(F.count(F.lit(1)).alias("n"), blocked.alias("b")), "paths")
    purity = template_purity(in_lane.groupBy(*key).agg(F.sum("n").alias("n"), F.sum("b").alias("b")), tree)
    judged = in_lane.select(*key, "lane").join(purity, key)
    out = rows.join(judged, [*key, "lane"])
    by_template = F.when(F.col("q") > tree.limit, F.lit("block")).otherwise(F.lit("allow"))
    return out.select(id_col, "host", "path", "rule", F.coalesce("said", by_template).alias("verdict"))
