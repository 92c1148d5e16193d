"""URL verdicts: path rules first, then trust and distrust spread over the host graph.

Rules name a host and a path prefix. Urls that no rule fits get the verdict of their host:
trust flows from hosts with allowed pages along links (personalised PageRank), distrust
flows from hosts with blocked pages against them, as a page that links to a bad host is
itself suspect. A host is blocked where distrust outweighs trust.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.text import LOWER, UPPER
from ledgerspark.operators.quality import own_exchange
from ledgerspark.session import materialize


@dataclass(frozen=True)
class Rule:
    """A verdict for a host with all its subdomains, below a path prefix (starts with /)."""

    host: str
    path: str
    verdict: str  # "allow" or "block"


# The rules of the registered query.
RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)

def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null without it."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _best_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Struct of the longest fitting rule, null if none fits.

    Rules are few and given, so they become one CASE, longest first: by rule text, then by
    host; the earlier rule of two equal ones wins.
    """
    ordered = sorted(rules, key=lambda r: (-len(r.host + r.path), -len(r.host)))
    whens = [
        (
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.struct(
                F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict")
            ),
        )
        for r in ordered
    ]
    if not whens:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    first, *rest = whens
    return reduce(lambda case, w: case.when(*w), rest, F.when(*first))


def match_rules(
    pages: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """page_id, host, path, rule, rule_verdict; a null url has an empty host and path."""
    rows = pages.select(
        F.col(page_id).alias("page_id"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
    )
    rows = rows.withColumn("best", _best_rule(F.col("host"), F.col("path"), rules))
    return rows.select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.col("best.verdict").alias("rule_verdict"),
    )


# The scheme and host of each link, as far as it has them.
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?(?://[^/?#"'\s>]*)?)"""


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """src, dst, n: pages of one host that link to another.

    Relative links stay on the host of their page. Links of other schemes than http and
    https (mailto:, javascript:) are left out.
    """

    def target(link: Column) -> Column:
        host = F.translate(F.regexp_extract(link, "//(.*)$", 1), UPPER, LOWER)
        return F.when(link.rlike("(?i)^(https?:)?//"), host).when(link == "", link)

    found = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(LINK), 1)
    links = pages.select(
        host_of(F.col(url)).alias("src"),
        F.explode(F.array_distinct(F.transform(found, target))).alias("link"),
    )
    dst = F.when(F.col("link") == "", F.col("src")).otherwise(F.col("link"))
    return (
        links.where("link IS NOT NULL")
        .select("src", dst.alias("dst"))
        .where("src <> '' AND dst <> ''")
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _steps(edges: DataFrame) -> DataFrame:
    """from, to, w_trust, w_distrust: shares of a host's mass along its links and against them."""
    out = edges.groupBy(F.col("src").alias("host")).agg(F.sum("n").alias("total"))
    into = edges.groupBy(F.col("dst").alias("host")).agg(F.sum("n").alias("total"))
    forward = edges.join(own_exchange(out), edges["src"] == F.col("host")).select(
        F.col("src").alias("from"), F.col("dst").alias("to"),
        (F.col("n") / F.col("total")).alias("w_trust"), F.lit(0.0).alias("w_distrust"),
    )
    backward = edges.join(own_exchange(into), edges["dst"] == F.col("host")).select(
        F.col("dst").alias("from"), F.col("src").alias("to"),
        F.lit(0.0).alias("w_trust"), (F.col("n") / F.col("total")).alias("w_distrust"),
    )
    return (
        forward.unionByName(backward)
        .groupBy("from", "to")
        .agg(F.sum("w_trust").alias("w_trust"), F.sum("w_distrust").alias("w_distrust"))
    )


def spread(
    edges: DataFrame,
    seeds: DataFrame,
    damping: float = 0.85,
    tolerance: float = 1e-9,
    rounds_per_table: int = 2,
) -> DataFrame:
    """host, trust, distrust of all hosts that either score reaches; each score adds up to one.

    ``seeds``: host, allowed, blocked (page counts). One table of weighted steps serves both
    directions, so each round is one join and one aggregate whose map side adds up the
    messages for a host before they are shuffled. Links are counted per page and host pair,
    so the steps grow with host pairs, not with pages. Rounds go on until one changes less
    than ``tolerance`` of all mass, which 130 rounds always reach; every few rounds the
    scores are stored, and four sums pass the driver. Mass at a host without steps goes back to the seeds: scores without that
    return differ from those with it by a common factor only, so they are scaled at the end.
    Without allowed (blocked) pages all trust (distrust) is zero.
    """
    steps = materialize(_steps(edges), "host-steps")
    seeds = materialize(seeds, "host-seeds")
    allowed, blocked = seeds.agg(F.sum("allowed"), F.sum("blocked")).first()
    start = seeds.select(
        "host",
        (F.col("allowed") / F.lit(float(allowed or 1))).alias("trust"),
        (F.col("blocked") / F.lit(float(blocked or 1))).alias("distrust"),
    )
    zero = F.lit(0.0)
    seeded = start.select(
        "host",
        ((1 - damping) * F.col("trust")).alias("trust"),
        ((1 - damping) * F.col("distrust")).alias("distrust"),
        zero.alias("was_trust"), zero.alias("was_distrust"),
    )
    scores, change = start, 1.0
    while change > tolerance:
        for _ in range(rounds_per_table):
            # Scores are an aggregate by host, whose exchange must not be that of the join.
            sent = own_exchange(scores.select("host", "trust", "distrust")).join(
                steps, F.col("host") == F.col("from")
            ).select(
                F.col("to").alias("host"),
                (damping * F.col("trust") * F.col("w_trust")).alias("trust"),
                (damping * F.col("distrust") * F.col("w_distrust")).alias("distrust"),
                zero.alias("was_trust"), zero.alias("was_distrust"),
            )
            before = scores.select(
                "host", zero.alias("trust"), zero.alias("distrust"),
                F.col("trust").alias("was_trust"), F.col("distrust").alias("was_distrust"),
            )
            scores = (
                seeded.unionByName(sent).unionByName(before)
                .groupBy("host")
                .agg(*(F.sum(c).alias(c) for c in ("trust", "distrust", "was_trust", "was_distrust")))
            )
        scores = materialize(scores, "host-scores")
        trust, distrust, *changes = scores.agg(
            F.sum("trust"), F.sum("distrust"),
            F.sum(F.abs(F.col("trust") - F.col("was_trust"))),
            F.sum(F.abs(F.col("distrust") - F.col("was_distrust"))),
        ).first()
        change = max((x or 0.0) / (total or 1.0) for x, total in zip(changes, (trust, distrust)))
    return scores.select(
        "host",
        (F.col("trust") / F.lit(trust or 1.0)).alias("trust"),
        (F.col("distrust") / F.lit(distrust or 1.0)).alias("distrust"),
    )


def url_verdicts(
    pages: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    damping: float = 0.85,
    threshold: float = 1.0,
    tolerance: float = 1e-9,
) -> DataFrame:
    """page_id, host, path, rule, verdict for every page.

    The verdict is that of the longest rule, else that of the host: block if its distrust
    is more than ``threshold`` times its trust, and by more than a millionth, so that the
    order of sums does not decide between equal scores. A host without any evidence is allowed, as
    is a url without a host (null, or no ``://``), whose host and path are empty. Null html
    has no links. Repeated pages and null ids are judged like others, one row each;
    further columns are ignored; an empty table gives an empty result.
    """
    matched = match_rules(pages, rules, page_id, url)
    seeds = matched.where("host <> ''").groupBy("host").agg(
        F.count_if(F.col("rule_verdict") == "allow").alias("allowed"),
        F.count_if(F.col("rule_verdict") == "block").alias("blocked"),
    )
    edges = materialize(host_edges(pages, url, html), "host-edges")
    scores = spread(edges, seeds, damping, tolerance)
    scored = matched.join(own_exchange(scores), "host", "left")
    by_host = F.coalesce(F.col("distrust"), F.lit(0.0)) > threshold * (
        1 + 1e-6
    ) * F.coalesce(F.col("trust"), F.lit(0.0))
    return scored.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce(
            F.col("rule_verdict"), F.when(by_host, F.lit("block")).otherwise(F.lit("allow"))
        ).alias("verdict"),
    )
