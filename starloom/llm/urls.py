"""URL rules, and block decisions carried over redirects and canonical links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.graph import components
from starloom.staging import settle

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CANONICAL = r"""(?is)<link\s[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
_REFRESH = r"""(?is)<meta\s[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
#: A value in double quotes, in single quotes, or bare.
_HREF = r"""(?is)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^"'\s>]+))"""
_CONTENT = r"""(?is)\bcontent\s*=\s*(?:"([^"]*)"|'([^']*)'|([^"'\s>]+))"""
_GOAL = r"""(?is)^\s*[0-9.]*\s*[;,]?\s*url\s*=\s*["']?([^"']*)"""
#: Parts of a page whose tags are none: comments, and elements of plain text.
_PLAIN = r"(?is)<!--.*?-->|<(script|style|textarea|title)\b[^>]*>.*?</\1\s*>"
#: Character references that URLs hold, by the character they stand for.
_REFERENCES = [
    ("&quot;|&#0*34;|&#[xX]0*22;", '"'), ("&apos;|&#0*39;|&#[xX]0*27;", "'"), ("&lt;|&#0*60;|&#[xX]0*3[cC];", "<"),
    ("&gt;|&#0*62;|&#[xX]0*3[eE];", ">"), ("&sol;|&#0*47;|&#[xX]0*2[fF];", "/"),
    ("&colon;|&#0*58;|&#[xX]0*3[aA];", ":"), ("&amp;|&#0*38;|&#[xX]0*26;", "&"),
]


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host(url: Column) -> Column:
    """Up to the first ``/``, ``?`` or ``#`` after ``://``, A-Z lower-cased; else empty."""
    found = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    """From the host's end up to the first ``?`` or ``#``; without ``://`` empty."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def node(url: Column) -> Column:
    """A URL's identity as an alias: host, path and query, without scheme and fragment."""
    query = F.coalesce(F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)?", 1), F.lit(""))
    return F.when(F.instr(url, "://") > 0, F.concat(host(url), path(url), query))


def _without_dots(place: Column) -> Column:
    """The path without ``.`` and ``..`` segments; ``..`` never goes above the top."""
    segments = F.split(place, "/")
    kept = F.aggregate(
        segments, F.array().cast("array<string>"),
        lambda acc, x: F.when(x == ".", acc)
        .when(x == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(1))))
        .otherwise(F.concat(acc, F.array(x))),
    )
    open_end = F.element_at(segments, -1).isin(".", "..")
    joined = F.array_join(F.when(open_end, F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")
    return F.when(place.rlike(r"/\.{1,2}(/|$)"), joined).otherwise(place)


def settled_node(url: Column) -> Column:
    """``node`` of the URL in its plain form: no user info, no port that the scheme has anyway, no
    dot segments, and ``/`` for an empty path."""
    scheme = F.lower(F.regexp_extract(url, r"^(.*?)://", 1))
    name = F.regexp_replace(host(url), "^.*@", "")
    usual = F.when(scheme == "http", "(:80|:)$").when(scheme == "https", "(:443|:)$").otherwise(":$")
    name = F.call_function("regexp_replace", name, usual, F.lit(""))
    place = _without_dots(path(url))
    query = F.coalesce(F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)?", 1), F.lit(""))
    whole = F.concat(name, F.when(place == "", F.lit("/")).otherwise(place), query)
    return F.when(F.instr(url, "://") > 0, whole)


def _attribute(tag: Column, pattern: str) -> Column:
    """An attribute's value without quotes, its character references replaced, trimmed."""
    value = F.concat(*[F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)])
    for found, character in _REFERENCES:
        value = F.regexp_replace(value, found, character)
    return F.btrim(value, F.lit(" \t\n\r\f"))


def _absolute(base: Column, link: Column) -> Column:
    """``link`` as a page at ``base`` means it; its dot segments are still there."""
    scheme = F.regexp_extract(base, r"^(.*?)://", 1)
    top = F.concat(scheme, F.lit("://"), F.regexp_extract(_rest(base), r"^[^/?#]*", 0))
    folder = F.regexp_extract(path(base), r"^.*/", 0)
    query = F.coalesce(F.regexp_extract(_rest(base), r"^[^?#]*(\?[^#]*)?", 1), F.lit(""))
    return (
        F.when(link.isNull() | (link == ""), F.lit(None))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(top, link))
        .when(link.startswith("?"), F.concat(top, path(base), link))
        .when(link.startswith("#"), F.concat(top, path(base), query, link))
        .otherwise(
            F.concat(top, F.when(folder == "", F.lit("/")).otherwise(folder), link)
        )
    )


def alias_edges(pages: DataFrame) -> DataFrame:
    """Edges (a, b) between the nodes of pages and those that their canonical link and
    refresh redirect name, and from each page's node to its plain form. Links in comments, scripts
    and other plain text are none, and links that lead to the page itself give none."""
    url = F.col("url")
    linked = pages.where(F.col("html").rlike(r"(?i)canonical|http-equiv"))
    html = F.when(F.col("html").rlike(r"(?i)<!--|<(script|style|textarea|title)\b"),
                  F.regexp_replace("html", _PLAIN, "")).otherwise(F.col("html"))
    linked = linked.select("url", html.alias("html"))
    link = _attribute(F.regexp_extract("html", _CANONICAL, 0), _HREF)
    goal = F.regexp_extract(_attribute(F.regexp_extract("html", _REFRESH, 0), _CONTENT), _GOAL, 1)
    ends = linked.select("url", F.explode(F.array(link, F.btrim(goal))).alias("link"))
    named = ends.select(node(url).alias("a"), settled_node(_absolute(url, F.col("link"))).alias("b"))
    plain = pages.select(node(url).alias("a"), settled_node(url).alias("b"))
    return named.union(plain).where("a <> b").distinct()


def rules_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (verdict, host, path)."""
    return spark.createDataFrame(list(rules), "rule_verdict string, rule_host string, rule_path string")


def _host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, fits): the rules of each host and of the domains above it."""
    labels = F.split("host", r"\.")
    above = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."),
    )
    fits = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("n"),
        F.concat("rule_host", "rule_path").alias("rule"), "rule_path", "rule_verdict",
    )
    return (
        hosts.select("host", F.explode(above).alias("rule_host"))
        .join(rules, "rule_host")
        .groupBy("host")
        .agg(F.collect_list(fits).alias("fits"))
    )


def _decided(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls(host, path, ...)`` with the longest fitting rule and its verdict; else nulls.

    Hosts are made distinct first, so a host that has a third of all rows meets the rules once.
    Of two equally long rules the later in order (rule, verdict) counts; allow beats block on the
    same rule.
    """
    # written first: its size tells whether it is broadcast, and else a host's rows can be split
    known = settle(_host_rules(urls.select("host").distinct(), rules), "host_rules")
    found = F.filter("fits", lambda r: F.expr("path").startswith(r["rule_path"]))
    order = F.transform(
        found,
        lambda r: F.struct(
            r["n"].alias("n"), r["rule"].alias("rule"),
            (r["rule_verdict"] == "allow").alias("allow"), r["rule_verdict"].alias("verdict"),
        ),
    )
    return (
        urls.join(known, "host", "left")
        .withColumn("best", F.array_max(order))
        .withColumns({"rule": F.col("best.rule"), "rule_verdict": F.col("best.verdict")})
        .drop("fits", "best")
    )


def judge(
    pages: DataFrame, rules: DataFrame, edges: DataFrame | None = None, default: str = "allow"
) -> DataFrame:
    """One row per row of ``pages(page_id, url, html)``: host, path, rule and verdict.

    The longest rule that fits a URL decides it. A URL that no rule fits is blocked if a URL it is
    equivalent to is blocked by a rule: equivalent are the URLs of a component over redirects
    and canonical links (``alias_edges`` of the pages, and ``edges(a, b)`` between URLs, such as
    a crawler's redirect log); a URL and its plain form are equivalent too. An explicit allow stands for its own URL, whatever its aliases are;
    it does not free aliases from a block. All others get ``default``.

    Rules are (rule_verdict, rule_host, rule_path) and hold for subdomains too. Null URLs have
    empty host and path, no rule and no aliases; null html has no links. Repeated rows give
    repeated rows; an empty table gives an empty one.
    """
    urls = pages.select(
        "page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"),
        node(F.col("url")).alias("node"),
    )
    links = alias_edges(pages)
    if edges is not None:
        log = edges.select(F.explode(F.array("a", "b")).alias("u"), "a", "b")
        log = log.select(node(F.col("a")).alias("a"), node(F.col("b")).alias("b")).union(
            log.select(node(F.col("u")).alias("a"), settled_node(F.col("u")).alias("b"))
        )
        links = links.union(log.where("a <> b"))
    links = settle(links, "alias_edges")
    decided = _decided(urls, rules)
    blocked = F.lit(False)
    if not links.isEmpty():
        groups = components(links)
        # a node's text up to its query is host and path again
        parts = groups.select(
            "component", host(F.concat(F.lit("x://"), "node")).alias("host"),
            path(F.concat(F.lit("x://"), "node")).alias("path"),
        )
        bad = (
            _decided(parts, rules).where("rule_verdict = 'block'").select("component").distinct()
        )
        bad = groups.join(bad, "component", "left_semi").select("node", F.lit(True).alias("bad"))
        decided = decided.join(bad, "node", "left")
        blocked = F.coalesce("bad", F.lit(False))
    other = F.when(blocked, F.lit("block")).otherwise(F.lit(default))
    return decided.select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", other).alias("verdict")
    )
