"""URL filter: host and path rules, and block decisions passed on along redirects and canonical links.

A page's own rule decides first; the longest rule that fits wins, allow before block
among equally long ones. Pages that no rule fits take the method's verdict: URLs
linked by redirect (``<meta http-equiv="refresh">``), by ``<link rel="canonical">`` or
by a row of ``redirects`` are aliases of each other, and a block on any alias blocks
the component. An explicit allow on the page itself takes precedence over such a
block. Everything else is allowed. Relative targets are resolved against the page's
URL: its host and folder, without dot segments.

Defined results: a null URL or one without ``://`` has empty host and path, fits no
rule and has no alias, so it is allowed; a null page has no links; repeated rows get
equal verdicts; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.llm.common import components

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)([^#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, group), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(_part(url, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return _part(url, 2)


def node_of(url: Column) -> Column:
    """Id of the address behind a URL: scheme and fragment do not count; null without a host."""
    host = host_of(url)
    return F.when(host != "", F.xxhash64(host, _part(url, 2), _part(url, 3)))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """``(rule, verdict)`` of the longest fitting rule; ``rules`` are ``(verdict, "host/path")``."""
    rule = verdict = None
    for kind, text in sorted(rules, key=lambda r: (-len(r[1]), r[0] != "allow")):
        h, slash, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        if rule is None:
            rule, verdict = F.when(fits, F.lit(text)), F.when(fits, F.lit(kind))
        else:
            rule, verdict = rule.when(fits, F.lit(text)), verdict.when(fits, F.lit(kind))
    if rule is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return rule, verdict


def resolved(url: Column, to: Column) -> Column:
    """The reference ``to`` on the page ``url`` made absolute; null for schemes without ``//`` (``mailto:``)."""
    path = F.regexp_extract(to, "^[^?#]*", 0)
    rest = to.substr(F.length(path) + 1, F.length(to))
    folder = F.concat(F.lit("/"), F.regexp_extract(path_of(url), "(?s)^/(.*/)?", 1))
    whole = F.when(path.startswith("/"), path).otherwise(F.concat(folder, path))
    segments = F.split(whole.substr(F.lit(2), F.length(whole)), "/", -1)
    last = F.element_at(segments, -1)
    segments = F.when(last.isin(".", ".."), F.concat(segments, F.array(F.lit("")))).otherwise(segments)
    kept = F.aggregate(
        segments, F.array().cast("array<string>"),
        lambda up, x: F.when(x == "..", F.slice(up, F.lit(1), F.greatest(F.size(up) - 1, F.lit(0))))
        .when(x == ".", up).otherwise(F.concat(up, F.array(x))),
    )
    place = F.concat(F.lit("/"), F.array_join(kept, "/"))
    site = F.concat(F.lit("x://"), host_of(url))
    return (
        F.when(to.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), to)
        .when(to.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
        .when(to.startswith("//"), F.concat(F.lit("x:"), to))
        .when(path != "", F.concat(site, place, rest))
        .when(to.startswith("?"), F.concat(site, path_of(url), rest))
        .otherwise(F.concat(site, path_of(url), _part(url, 3), rest))
    )


def page_links(pages: DataFrame) -> DataFrame:
    """``(url, target)``: canonical links and refresh redirects that pages declare, relative ones resolved."""
    marked = pages.filter(
        F.col("html").rlike("(?i)canonical|http-equiv") & F.col("url").isNotNull()
    )
    tags = F.regexp_extract_all("html", F.lit("(?is)<(?:link|meta)\\b[^>]*>"), F.lit(0))
    tag = marked.select("url", F.explode(tags).alias("tag"))
    canonical = F.when(
        F.col("tag").rlike("(?i)\\brel\\s*=\\s*[\"']?canonical\\b"),
        F.regexp_extract("tag", "(?i)\\bhref\\s*=\\s*[\"']?([^\"'\\s>]+)", 1),
    )
    refresh = F.when(
        F.col("tag").rlike("(?i)\\bhttp-equiv\\s*=\\s*[\"']?refresh\\b"),
        F.regexp_extract("tag", "(?i)\\burl\\s*=\\s*[\"']?([^\"'\\s>]+)", 1),
    )
    to = tag.select("url", F.coalesce(canonical, refresh).alias("to")).filter(F.col("to") != "")
    absolute = resolved(F.col("url"), F.col("to"))
    return to.select("url", absolute.alias("target")).filter(F.col("target").isNotNull())


def url_verdicts(
    pages: DataFrame, rules: list[tuple[str, str]], redirects: DataFrame | None = None
) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` per page; ``redirects(url, target)`` adds alias edges."""
    links = page_links(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select("url", "target"))
    ends = links.select(F.explode(F.array("url", "target")).alias("url"))
    edges = links.select(
        node_of(F.col("url")).alias("src"), node_of(F.col("target")).alias("dst")
    ).dropna()
    groups = components(edges)

    url = F.col("url")
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    known = pages.select("url").unionByName(ends).select(
        node_of(url).alias("node"), host_of(url).alias("host"), path_of(url).alias("path")
    )
    blocked = (
        known.filter(F.col("node").isNotNull() & (verdict == "block"))
        .select("node").distinct()
        .join(groups, "node").select("component").distinct()
    )
    spread = groups.join(blocked, "component").select("node", F.lit(True).alias("blocked"))
    judged = pages.select(
        "page_id", host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node")
    )
    judged = judged.join(spread, "node", "left")
    return judged.select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("blocked"), F.lit("block")), F.lit("allow")).alias("verdict"),
    )
