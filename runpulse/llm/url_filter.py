"""URL verdicts from host and path rules, carried to aliases along redirects and canonical links. SQL only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from runpulse.llm.columns import passing_on
from runpulse.operators.components import connected_components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """What stands between the first `://` and the next `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty where there is no `://`."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule (host, path, verdict) that fits, as a struct (`size`, `allow`, `rule`, `verdict`), or null.

    A rule fits its host and all subdomains, where the path starts with the rule's. Of equally long ones an
    allowing rule wins. The rules are a short list given by the caller; they become part of the plan.
    """
    one = [
        F.when(
            ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)),
            F.struct(
                F.lit(len(h + p)).alias("size"), F.lit(v == "allow").alias("allow"), F.lit(h + p).alias("rule"),
                F.lit(v).alias("verdict"),
            ),
        )
        for h, p, v in rules
    ]
    return F.array_max(F.array(*one)) if one else F.lit(None).cast(
        "struct<size:int,allow:boolean,rule:string,verdict:string>"
    )


def _tags(html: Column, name: str) -> Column:
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{name}\b[^>]*>"), F.lit(0))


def _attribute(tag: Column, name: str) -> Column:
    quoted = F.regexp_extract(tag, rf"""(?is)[\s"'/]{name}\s*=\s*("([^"]*)"|'([^']*)'|([^\s"'>]+))""", 1)
    return F.replace(F.regexp_replace(quoted, r"""^["']|["']$""", ""), F.lit("&amp;"), F.lit("&"))


def linked_urls(html: Column) -> Column:
    """The targets of all canonical links and refresh redirects of a page, as written."""
    canonical = F.transform(
        F.filter(_tags(html, "link"), lambda t: F.array_contains(F.split(F.lower(_attribute(t, "rel")), r"\s+"), "canonical")),
        lambda t: _attribute(t, "href"),
    )
    refresh = F.transform(
        F.filter(_tags(html, "meta"), lambda t: F.lower(_attribute(t, "http-equiv")) == "refresh"),
        lambda t: F.regexp_extract(_attribute(t, "content"), r"""(?is)url\s*=\s*["']?([^"']*)""", 1),
    )
    return F.filter(F.concat(canonical, refresh), lambda x: F.trim(x) != "")


def _resolved(target: Column, host: Column, path: Column) -> Column:
    """The target as an absolute URL: as it is, or with the page's host, or below the page's folder."""
    t = F.trim(target)
    folder = F.when(path == "", "/").otherwise(F.regexp_extract(path, r"(?s)^(.*/)", 1))
    return (
        F.when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), t)
        .when(F.startswith(t, F.lit("//")), F.concat(F.lit("x:"), t))
        .when(F.startswith(t, F.lit("/")), F.concat(F.lit("x://"), host, t))
        .when(t.rlike(r"^[?#]"), F.concat(F.lit("x://"), host, path))
        .otherwise(F.concat(F.lit("x://"), host, folder, t))
    )


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Edges (`u`, `v`) between the addresses (host and path) of pages and of what they redirect to or name
    as their canonical address."""
    host, path = url_host(F.col(url)), url_path(F.col(url))
    links = pages.select(host.alias("h"), path.alias("p"), F.explode(linked_urls(F.col(html))).alias("t"))
    to = links.select("h", F.concat("h", "p").alias("u"), _resolved(F.col("t"), F.col("h"), F.col("p")).alias("t"))
    edges = to.select("h", "u", F.concat(url_host(F.col("t")), url_path(F.col("t"))).alias("v"), url_host(F.col("t")).alias("g"))
    return edges.filter("h <> '' AND g <> '' AND u <> v").select("u", "v").distinct()


def judge_urls(
    pages: DataFrame, rules: list[tuple[str, str, str]], url: str = "url", html: str = "html", default: str = "allow"
) -> DataFrame:
    """`pages` without its html, with `host`, `path`, `rule` and `verdict`.

    A page that a rule fits has the rule's verdict. Others have that of their aliases: addresses connected by
    redirects and canonical links in either direction, through any number of steps. An address that a rule allows
    makes the whole component allowed, whatever else is in it; failing that, a blocked address blocks it. What
    is left has `default`.

    Addresses are host and path; scheme, query and fragment don't count. A url that is null or has no `://` has
    an empty host and path, no rule and no aliases. Null html has no links. Equal rows each give a row; columns
    named like the results are replaced, others passed on. An empty table gives no rows.
    """
    run = lambda p: _judged(p, rules, url, html, default)
    return passing_on(pages, [url, html], ["host", "path", "rule", "verdict"], run)


def _judged(pages, rules, url, html, default) -> DataFrame:
    kept = [F.col(c) for c in pages.columns if c != html]
    judged = pages.select(*kept, url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    judged = judged.withColumn("_rule", fitting_rule(F.col("host"), F.col("path"), rules))
    parts = connected_components(alias_edges(pages, url, html))
    node_host, node_path = F.regexp_extract("node", r"(?s)^([^/]*)", 1), F.regexp_extract("node", r"(?s)^[^/]*(.*)$", 1)
    fit = fitting_rule(node_host, node_path, rules)
    of_part = (
        parts.withColumn("fit", fit)
        .groupBy("component")
        .agg(F.max(F.col("fit.allow")).alias("allow"))
        .filter("allow IS NOT NULL")
    )
    known = parts.join(of_part, "component").select("node", F.when(F.col("allow"), "allow").otherwise("block").alias("_alias"))
    has = F.when(F.col("host") != "", F.concat("host", "path"))
    joined = judged.withColumn("_node", has).join(known, F.col("_node") == F.col("node"), "left")
    verdict = F.coalesce("_rule.verdict", "_alias", F.lit(default))
    return joined.select(
        *[c for c in judged.columns if c not in ("host", "path", "_rule")], "host", "path",
        F.col("_rule.rule").alias("rule"), verdict.alias("verdict"),
    )
