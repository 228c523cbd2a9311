"""URL rules, and for urls without a rule a verdict from the link graph between hosts.

Trust starts at hosts with allowed pages and follows links; distrust starts at hosts with blocked
pages and follows links backwards, to those who link there. Both are personalised PageRank. A host
is blocked if its distrust is above its trust and above ``block_at`` times the mean of all hosts.

Walks that end at a host without links start again at the seeds. That solution is, up to a factor,
the one in which such walks vanish, so the iteration needs no global sum: the scores are brought to
sum 1 afterwards. It goes on until a round adds no more than TOLERANCE; as a round adds at most the damping's part of what the one
before added, that holds after log(TOLERANCE) / log(damping) rounds at the latest. Edges are summed up by host pair before anything is
shuffled by host. The graph's hosts are those of pages and links without user and port, so that links reach pages at any port.

Defined results: null urls and urls without ``://`` have an empty host and path, fit no rule and
take no part in the graph, verdict ``allow``; so do hosts of user and port alone. Repeated rows are judged each; repeated links count
by their number. Links of a host to itself say nothing and are left out. Empty table: no rows.
Columns other than those made here are kept by ``judge_urls``; of equal names the made one stays.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import keep_names, lower_ascii, or_empty
from orderflow.session import pin, unpin

DAMPING, TOLERANCE, BLOCK_AT = 0.85, 1e-6, 1.0
#: Judged hosts up to this number are sent to the pages; beyond, pages and hosts meet by a shuffle.
BROADCAST_HOSTS = 500_000
#: Absolute and protocol-relative links of anchors and the like; relative ones stay on the host.
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @classmethod
    def of(cls, verdict: str, text: str) -> "Rule":
        host, slash, path = text.partition("/")
        return cls(verdict, host.lower(), slash + path)

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring({0}, instr({0}, '://') + 3)".format("_url")))
    host = lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def fitting_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """String and verdict of the longest rule that fits, else null."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text = F.when(fits, F.lit(r.text)).otherwise(text)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def graph_host(host: Column) -> Column:
    """The host without user and port."""
    return F.regexp_replace(host, r"^.*@|:\d*$", "")


def host_edges(pages: DataFrame, host: str = "host", html: str = "html") -> DataFrame:
    """(src, dst, weight): how often pages of one host link to another host."""
    links = F.explode(F.regexp_extract_all(or_empty(html), F.lit(LINK), F.lit(1)))
    found = pages.where(F.col(host) != "").select(F.col(host).alias("src"), links.alias("link"))
    target = graph_host(lower_ascii(F.col("link")))
    return (
        found.select("src", target.alias("dst"))
        .where("dst != '' AND src != dst")
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )


def propagate(
    seeds: DataFrame,
    edges: DataFrame,
    damping: float = DAMPING,
    rounds: int | None = None,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """(kind, host, score): personalised PageRank of each kind from ``seeds`` (kind, host, score) over
    ``edges`` (kind, src, dst, weight); seed scores and results sum to 1 for each kind. Goes on until ``tolerance`` holds, or for
    ``rounds`` rounds if they are given."""
    leaving = edges.groupBy("kind", "src").agg(F.sum("weight").alias("leaving"))
    shares = pin(
        edges.join(leaving, ["kind", "src"]).select("kind", "src", "dst", (F.col("weight") / F.col("leaving")).alias("share"))
    )
    start = pin(seeds.select("kind", "host", (F.col("score") * (1 - damping)).alias("score")))
    now, before = start, start.agg(F.sum("score")).first()[0] or 0.0
    while rounds is None or rounds > 0:
        moved = now.join(shares, (now.kind == shares.kind) & (now.host == shares.src)).select(
            shares.kind, F.col("dst").alias("host"), (now.score * shares.share * damping).alias("score")
        )
        later = pin(start.unionByName(moved).groupBy("kind", "host").agg(F.sum("score").alias("score")))
        if now is not start:
            unpin(now)
        now, last = later, before
        # Scores only grow; what their sum gains in a round tells what is still moving.
        before = now.agg(F.sum("score")).first()[0] or 0.0
        rounds = rounds and rounds - 1
        if before - last <= tolerance:
            break
    total = now.groupBy("kind").agg(F.sum("score").alias("total"))
    return now.join(F.broadcast(total), "kind").select("kind", "host", (F.col("score") / F.col("total")).alias("score"))


def judge_urls(
    pages: DataFrame,
    rules: list[Rule],
    url: str = "url",
    html: str = "html",
    damping: float = DAMPING,
    rounds: int | None = None,
    block_at: float = BLOCK_AT,
) -> DataFrame:
    """Adds host, path, rule, verdict, trust and distrust (multiples of the mean host) to every row."""
    made = ("host", "path", "rule", "verdict", "trust", "distrust")
    host, path = host_and_path(F.col("_url"))
    parsed = pages.withColumn("_url", F.col(url)).withColumns({"_host": host, "_path": path}).withColumn("_node", graph_host(F.col("_host")))
    text, verdict = fitting_rule(rules, F.col("_host"), F.col("_path"))
    ruled = parsed.withColumns({"_rule": text, "_ruled": verdict})

    hosts = ruled.where("_node != ''").groupBy(F.col("_node").alias("host")).agg(
        F.count_if(F.col("_ruled") == "allow").alias("allowed"), F.count_if(F.col("_ruled") == "block").alias("blocked")
    )
    hosts = pin(hosts)
    counts = hosts.agg(F.sum("allowed"), F.sum("blocked")).first()
    edges = pin(host_edges(parsed, "_node", html))
    seeds = hosts.select(
        F.explode(
            F.array(
                F.struct(F.lit("trust").alias("kind"), (F.col("allowed") / F.lit(counts[0] or 1)).alias("score")),
                F.struct(F.lit("distrust").alias("kind"), (F.col("blocked") / F.lit(counts[1] or 1)).alias("score")),
            )
        ).alias("s"),
        "host",
    ).select("s.kind", "host", "s.score").where("score > 0")
    flows = edges.select(F.lit("trust").alias("kind"), "src", "dst", "weight").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    )
    scores = propagate(seeds, flows, damping, rounds).groupBy("host").agg(
        *[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0)).alias(k) for k in ("trust", "distrust")]
    )
    every = hosts.select("host").unionByName(edges.select(F.col("dst").alias("host"))).groupBy("host").agg(F.lit(1).alias("one"))
    count = every.count()
    n = F.lit(float(count))
    judged = scores.select(
        F.col("host").alias("_node"), (F.col("trust") * n).alias("trust"), (F.col("distrust") * n).alias("distrust")
    )
    if count <= BROADCAST_HOSTS:
        judged = F.broadcast(judged)
    bad = (F.col("distrust") > F.col("trust")) & (F.col("distrust") >= F.lit(block_at))
    return (
        ruled.select(*keep_names(pages, *made), "_host", "_path", "_node", "_rule", "_ruled")
        .join(judged, "_node", "left")
        .withColumn("verdict", F.coalesce("_ruled", F.when(bad, "block"), F.lit("allow")))
        .select(
            *keep_names(pages, *made),
            F.col("_host").alias("host"),
            F.col("_path").alias("path"),
            F.col("_rule").alias("rule"),
            "verdict",
            F.coalesce("trust", F.lit(0.0)).alias("trust"),
            F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
        )
    )
