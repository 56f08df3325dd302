"""URL block and allow rules, carried along redirects and canonical links."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.llm.common import ascii_lower, saved
from cartwright.llm.components import components


class Rule(NamedTuple):
    """``verdict`` (allow or block) for a host with its subdomains, under a path prefix."""

    verdict: str
    host: str
    path: str


def url_host(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty without ``://``."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as struct(rule, verdict), else NULL.

    Of rules of one length, the one with the longer host comes first, then allow before block.
    The rules are a list that the caller holds, so they become one expression without a join.
    """
    ordered = sorted(
        set(rules), key=lambda r: (-len(r.host + r.path), -len(r.host), r.verdict, r.host, r.path)
    )
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in reversed(ordered):
        at_host = (host == rule.host) | host.endswith(f".{rule.host}")
        made = F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(at_host & path.startswith(rule.path), made).otherwise(found)
    return found


def _node(url: Column) -> Column:
    """What identifies a resource: its URL without the fragment."""
    return F.regexp_extract(url, "^[^#]*", 0)


def link_edges(pages: DataFrame) -> DataFrame:
    """(alias, target) for every canonical link and meta refresh in the pages' HTML.

    Targets starting with ``//`` or ``/`` are resolved against the page; other relative targets
    against its folder. Pages without a URL have no edges. No shuffle.
    """
    quoted = r"""\s*=\s*["']?\s*"""
    canonical = rf"(?is)<link\b[^>]*\brel{quoted}canonical\b[^>]*>"
    refresh = rf"(?is)<meta\b[^>]*\bhttp-equiv{quoted}refresh\b[^>]*>"
    html = F.col("html")
    found = pages.filter(F.col("url").contains("://") & html.rlike("(?i)canonical|refresh")).select(
        _node(F.col("url")).alias("alias"),
        F.explode(
            F.concat(
                F.transform(
                    F.regexp_extract_all(html, F.lit(canonical), F.lit(0)),
                    lambda tag: F.regexp_extract(tag, rf"""(?is)\bhref{quoted}([^"'\s>]+)""", 1),
                ),
                F.transform(
                    F.regexp_extract_all(html, F.lit(refresh), F.lit(0)),
                    lambda tag: F.regexp_extract(tag, r"""(?is)\burl\s*=\s*["']?\s*([^"'\s>;]+)""", 1),
                ),
            )
        ).alias("link"),
    )
    alias, link = F.col("alias"), F.replace(F.col("link"), F.lit("&amp;"), F.lit("&"))
    scheme = F.regexp_extract(alias, "^(.*?):/", 1)
    site = F.regexp_extract(alias, "^(.*?://[^/?]*)", 1)
    folder = F.regexp_extract(alias, "^(.*?://[^/?]*[^?]*/)", 1)
    target = (
        F.when(link.contains("://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(site, link))
        .otherwise(F.concat(F.when(folder == "", F.concat(site, F.lit("/"))).otherwise(folder), link))
    )
    return found.filter(F.col("link") != "").select("alias", _node(target).alias("target"))


def filter_urls(
    pages: DataFrame, rules: Sequence[Rule], edges: DataFrame | None = None
) -> DataFrame:
    """Judge every page: its own rule's verdict, else that of the pages it is equivalent to.

    URLs joined by redirect or canonical-link edges (``edges`` with ``alias`` and ``target``, by
    default those found in ``html``) form components. A page that fits a rule keeps that rule's
    verdict. Any other page takes its component's: allow if one of its URLs is explicitly allowed,
    else block if one is blocked, else allow.

    Returns page_id, host, path, rule, verdict; one row per input row, repeated rows included. A
    URL that is NULL or without ``://`` has an empty host and path, fits no rule and is allowed;
    NULL html has no links; an empty table gives no rows; other columns of ``pages`` don't matter.

    Only URLs with an edge are shuffled to find components; the pages are shuffled once, without
    their HTML, to look their component up.
    """
    found = link_edges(pages) if edges is None else edges.select(
        _node(F.col("alias")).alias("alias"), _node(F.col("target")).alias("target")
    )
    found = saved(found.distinct(), "links")
    url = F.col("url")
    judged = pages.select(
        "page_id", url_host(url).alias("host"), url_path(url).alias("path"), _node(url).alias("node")
    )
    judged = judged.withColumn("own", matching_rule(F.col("host"), F.col("path"), rules))
    nodes = components(found, "alias", "target")
    own = matching_rule(url_host(F.col("node")), url_path(F.col("node")), rules)["verdict"]
    verdicts = nodes.withColumn("own", own).groupBy("component").agg(
        F.when(F.bool_or(F.col("own") == "allow"), "allow")
        .when(F.bool_or(F.col("own") == "block"), "block")
        .alias("inherited")
    )
    inherited = nodes.join(verdicts, "component").filter("inherited IS NOT NULL").select("node", "inherited")
    return judged.join(inherited, "node", "left").select(
        "page_id",
        "host",
        "path",
        F.col("own.rule").alias("rule"),
        F.coalesce("own.verdict", "inherited", F.lit("allow")).alias("verdict"),
    )
