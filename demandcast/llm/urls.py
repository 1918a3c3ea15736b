"""URL rules with decisions spread over redirect and canonical-link aliases.

Only DataFrame functions: rules are matched per host suffix, aliases are connected components
over redirect and canonical-link edges, and a page without a rule of its own takes the decision
of its aliases, where an explicit allow comes before any block.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandcast.llm.common import connected_components, hash_filter, keep_possible
from demandcast.session import local_table, materialise

#: Up to this many rules travel with the plan and are looked up row by row; more are joined by host.
INLINE_RULES = 256

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# A tag ends at its first ">", and one that another "<" or the end of the page cuts off is none; so no search runs past a tag.
CANONICAL_TAG = r"(?is)<link\b[^<>]*\brel\s*=\s*[\"']?canonical\b[^<>]*>"
REFRESH_TAG = r"(?is)<meta\b[^<>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^<>]*>"
HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH_URL = r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)"


def closed(pattern: str) -> str:
    """The same tags for an engine that backtracks: whether the tag is closed is seen before anything in it is tried."""
    return pattern.replace(r"\b[^<>]*", r"\b(?=[^<>]*+>)[^<>]*", 1)


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Rules from (action, "host/path") pairs; the action is allow or block."""
    rows = [(a, *r.partition("/")[::2]) for a, r in rules]
    return local_table(spark, [(a, h, f"/{p}") for a, h, p in rows], action=pa.string(), rule_host=pa.string(),
                       rule_path=pa.string())


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(_rest(url), F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def node_of(url: Column) -> Column:
    """Identity of an address among aliases: no scheme and no fragment, host lower-cased; NULL without ``://``."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)", 1)
    return F.when(F.locate("://", url) > 0, F.concat(host_of(url), path_of(url), query))


def resolve(target: Column, url: Column) -> Column:
    """Absolute form of a link: absolute, ``//host``, ``/path`` or relative to the page's folder; NULL when empty."""
    t = F.replace(target, F.lit("&amp;"), F.lit("&"))
    scheme = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)
    base = F.concat(scheme, F.lit("://"), host_of(url))
    folder = F.regexp_extract(path_of(url), r"^(.*/)", 1)
    return F.when(F.length(F.coalesce(t, F.lit(""))) == 0, None).when(
        t.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), t).when(t.startswith("//"), F.concat(scheme, F.lit(":"), t)).when(
        t.startswith("/"), F.concat(base, t)).otherwise(
        F.concat(base, F.when(folder == "", "/").otherwise(folder), t))


def page_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src_url, dst_url) from canonical links and refresh redirects of each page."""
    u, h = F.col(f"`{url}`"), F.col(f"`{html}`")
    links = pages.where(h.isNotNull() & u.isNotNull()).select(
        u.alias("src_url"),
        F.regexp_extract(F.regexp_extract(h, closed(CANONICAL_TAG), 0), HREF, 1).alias("c"),
        F.regexp_extract(F.regexp_extract(h, closed(REFRESH_TAG), 0), REFRESH_URL, 1).alias("r"))
    return links.where("c <> '' OR r <> ''").select(
        "src_url", F.explode(F.array("c", "r")).alias("t")).select(
        "src_url", resolve(F.col("t"), F.col("src_url")).alias("dst_url")).where("dst_url IS NOT NULL")


def _suffixes(host: Column, depth: int) -> Column:
    """The host's last labels, 1 to ``depth`` of them, joined by dots; none of an empty host."""
    labels = F.split(host, r"\.")
    first = F.greatest(F.lit(1), F.size(labels) - depth + 1)
    tail = F.slice(labels, first, F.size(labels))
    return F.when(host != "", F.transform(F.sequence(F.lit(1), F.size(tail)),
                                          lambda i: F.array_join(F.slice(tail, i, F.size(tail)), ".")))


def _rules_by_host(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """Each distinct host with the rules of its suffixes; a host sees only its own chain of rules."""
    depth = rules.agg(F.max(F.size(F.split("rule_host", r"\.")))).first()[0]
    suffixes = hosts.select("host").distinct().select("host", F.explode(_suffixes(F.col("host"), depth)).alias("rule_host"))
    rule = F.struct((F.length("rule_host") + F.length("rule_path")).alias("n"), (F.col("action") == "allow").alias("allow"),
                    F.concat("rule_host", "rule_path").alias("rule"), F.col("rule_path").alias("path"))
    return suffixes.join(rules, "rule_host").groupBy("host").agg(F.collect_set(rule).alias("_rules"))


def _rules_of(host: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Rules of a host's suffixes, looked up in a constant map of (action, rule_host, rule_path)."""
    if not rules:
        return F.lit(None).cast("array<struct<n:int,allow:boolean,rule:string,path:string>>")
    chains: dict[str, list[Column]] = {}
    for action, of, path in rules:
        chains.setdefault(of, []).append(F.struct(
            F.lit(len(of) + len(path)).alias("n"), F.lit(action == "allow").alias("allow"), F.lit(of + path).alias("rule"), F.lit(path).alias("path")))
    known = F.create_map(*[c for of, chain in chains.items() for c in (F.lit(of), F.array(*chain))])
    depth = max(of.count(".") + 1 for of in chains)
    found = F.transform(_suffixes(host, depth), lambda s: F.element_at(known, s))
    return F.flatten(F.filter(found, lambda x: x.isNotNull()))


def match_rules(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Add ``rule`` and ``action`` of the longest fitting rule to rows with ``host`` and ``path``.

    Of rules of one length an allow goes first, then the later in order. Up to ``INLINE_RULES`` rules are looked up
    where the row is, without an exchange; with more, hosts are matched once each and joined back, and AQE splits a
    host with a third of all pages. Only a host's last labels, as many as the deepest rule has, are looked at.
    """
    rules = rules.select("action", "rule_host", "rule_path").where(
        "rule_host IS NOT NULL AND rule_path IS NOT NULL AND action IS NOT NULL").distinct()
    few = [tuple(r) for r in rules.limit(INLINE_RULES + 1).collect()]
    found = rows.withColumn("_rules", _rules_of(F.col("host"), few)) if len(few) <= INLINE_RULES else rows.join(
        _rules_by_host(rows, rules), "host", "left")
    best = F.array_max(F.filter("_rules", lambda r: F.col("path").startswith(r["path"])))
    return found.withColumn("_best", best).select(
        *rows.columns, F.col("_best.rule").alias("rule"),
        F.when(F.col("_best.allow"), "allow").when(F.col("_best.rule").isNotNull(), "block").alias("action"))


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None, key: str = "page_id",
          url: str = "url", html: str = "html") -> DataFrame:
    """(key, host, path, rule, verdict) for every page.

    Nodes are addresses without scheme and fragment; ``redirects`` may add (src_url, dst_url)
    rows to the edges found in the pages. A page with a rule follows it. Any other page is
    allowed if an alias is explicitly allowed, else blocked if an alias is blocked, else
    allowed; an alias that was never fetched counts through its own rule. A NULL address or one
    without ``://`` has an empty host and path, no aliases and is allowed. Repeated rows are
    each returned. Components are found over the linked addresses only; pages with a rule, and those whose address a
    filter of fixed size clears, are not shuffled.
    """
    u = F.col(f"`{url}`")
    base = pages.select(F.col(f"`{key}`").alias(key), host_of(u).alias("host"), path_of(u).alias("path"), node_of(u).alias("_node"))
    judged = match_rules(base, rules)
    links = page_edges(pages, url, html)
    if redirects is not None:
        links = links.unionByName(redirects.select("src_url", "dst_url"))
    edges = materialise(links.select(
        node_of(F.col("src_url")).alias("src"), node_of(F.col("dst_url")).alias("dst"), "src_url", "dst_url").where(
        "src IS NOT NULL AND dst IS NOT NULL AND src <> dst"))
    groups = materialise(connected_components(edges))
    ends = edges.select(F.explode(F.array("src_url", "dst_url")).alias("u")).select(
        node_of(F.col("u")).alias("node"), host_of(F.col("u")).alias("host"), path_of(F.col("u")).alias("path")).distinct()
    decisions = match_rules(ends, rules).where("action IS NOT NULL").join(groups, "node").groupBy("component").agg(
        F.min("action").alias("spread"))  # allow sorts before block
    aliases = materialise(groups.join(decisions, "component").select(F.col("node").alias("_node"), "spread"))
    flt = hash_filter(aliases, "_node")
    open_ = judged.where("action IS NULL")
    spread = keep_possible(open_, "_node", flt).join(aliases, "_node", "left")
    alone = judged.where("action IS NOT NULL").unionByName(keep_possible(open_, "_node", flt, others=True))
    verdict = F.coalesce("action", "spread", F.lit("allow")).alias("verdict")
    return spread.select(key, "host", "path", "rule", verdict).unionByName(
        alone.withColumn("spread", F.lit(None).cast("string")).select(key, "host", "path", "rule", verdict))
