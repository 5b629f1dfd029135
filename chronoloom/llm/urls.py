"""Allow and block rules over urls, carried to aliases through redirects and canonical links."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoloom.llm.graph import components
from chronoloom.llm.stored import stored


@dataclass(frozen=True)
class Rule:
    """``host`` with all its subdomains, and the paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def with_url_parts(frame: DataFrame, url: Column) -> DataFrame:
    """``frame`` with the host, path and node of a url, each step a projection of its own so that no expression is repeated.

    ``host`` and ``path`` are empty where there is no ``://``. ``node`` is the url without scheme and fragment, on which
    redirects and canonical links are followed; it is null where there is no host.
    """
    at = F.locate("://", url)
    split = frame.withColumn("__rest", F.coalesce(F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))), F.lit("")))
    split = split.withColumn("__authority", F.regexp_extract("__rest", r"^[^/?#]*", 0))
    split = split.withColumn("__tail", F.substring(F.col("__rest"), F.length("__authority") + 1, F.length("__rest")))
    split = split.withColumn("host", lower_ascii(F.col("__authority"))).withColumn("path", F.regexp_extract("__tail", r"^[^?#]*", 0))
    split = split.withColumn("__query", F.regexp_extract("__tail", r"^[^?#]*(\?[^#]*)?", 1))
    slash = F.when(F.startswith("path", F.lit("/")), F.lit("")).otherwise(F.lit("/"))
    node = F.when(F.col("host") != "", F.concat("host", slash, without_dots(F.col("path")), "__query"))
    return split.withColumn("node", node).drop("__rest", "__authority", "__tail", "__query")


def without_dots(path: Column) -> Column:
    """A path with its ``.`` and ``..`` steps walked; steps above the top are left out. A path that ends in one ends in a slash."""
    parts = F.split(path, "/")
    steps = F.aggregate(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == ".", done)
        .when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(part))),
    )
    last = F.element_at(parts, -1).isin(".", "..")
    walked = F.concat(F.lit("/"), F.array_join(steps, "/"), F.when(last & (F.size(steps) > 0), F.lit("/")).otherwise(F.lit("")))
    return F.when(path.rlike(r"^/(?:.*/)?\.\.?(?:/|$)"), walked).otherwise(path)


def link_targets(html: Column) -> Column:
    """Targets of canonical links and of refresh redirects in a page, as written, in page order.

    Only the head counts, since links in the text of a page say nothing about the page.
    """
    head = page_head(html)
    href = r"""\bhref\s*=\s*["']?\s*([^"'\s>]+)"""
    links = F.regexp_extract_all(head, F.lit(r"""(?is)(<link\b(?=[^>]*\brel\s*=\s*["']?[^"'>]*\bcanonical\b)[^>]*>)"""), 1)
    metas = F.regexp_extract_all(head, F.lit(r"""(?is)(<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?\s*refresh\b)[^>]*>)"""), 1)
    found = F.concat(
        F.transform(links, lambda tag: F.regexp_extract(tag, "(?is)" + href, 1)),
        F.transform(metas, lambda tag: F.regexp_extract(tag, r"""(?is)\burl\s*=\s*['"]?\s*([^"'\s>]+)""", 1)),
    )
    found = F.filter(F.transform(found, lambda x: F.replace(x, F.lit("&amp;"), F.lit("&"))), lambda x: x != "")
    return found


def page_head(html: Column) -> Column:
    """The markup before ``<body``, without comments, scripts and styles."""
    plain = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<!--.*?(?:-->|$)|<script\b.*?(?:</script\s*>|$)|<style\b.*?(?:</style\s*>|$)", " ")
    return F.regexp_extract(plain, r"(?is)^(.*?)(?:<body\b|$)", 1)


def base_target(html: Column) -> Column:
    """Where the first ``base`` element of a page's head points, as written; empty without one."""
    return F.replace(F.regexp_extract(page_head(html), r"""(?is)<base\b[^>]*\bhref\s*=\s*["']?\s*([^"'\s>]+)""", 1), F.lit("&amp;"), F.lit("&"))


def with_target_url(links: DataFrame) -> DataFrame:
    """``links`` of columns ``url`` and ``target`` with ``to``, the target as an absolute url, null if it is none. ``..`` and ``.`` are walked when nodes are made."""
    parts = with_url_parts(links.select("*", F.regexp_extract("url", r"^(.*?)://", 1).alias("scheme")), F.col("url"))
    base = F.concat("scheme", F.lit("://"), "host")
    folder = F.regexp_extract("path", r"^(.*/)", 1)
    target = F.col("target")
    to = (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(F.startswith(target, F.lit("//")), F.concat("scheme", F.lit(":"), target))
        .when(F.startswith(target, F.lit("/")), F.concat(base, target))
        .when(F.startswith(target, F.lit("?")), F.concat(base, "path", target))
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .otherwise(F.concat(base, F.when(F.startswith("path", F.lit("/")), folder).otherwise("/"), target))
    )
    return parts.select(*links.columns, to.alias("to"))


def own_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The fitting rule with the longest text as a struct (rule, verdict); null if none fits.

    Of rules with texts of the same length, the first given wins.
    """
    out = None
    for rule in sorted(rules, key=lambda r: -len(r.text)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        value = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def alias_edges(pages: DataFrame) -> DataFrame:
    """Edges (a, b) between urls that a redirect or canonical link declares to be the same."""
    marked = pages.where(F.col("html").rlike(r"(?i)canonical|refresh"))
    linked = marked.select("url", base_target(F.col("html")).alias("base"), F.explode(link_targets(F.col("html"))).alias("target"))
    linked = stored(linked, "url-links")
    # A base element, which may be relative to its page, is where relative targets start from.
    bases = with_target_url(linked.withColumnsRenamed({"url": "page", "target": "link"}).withColumnsRenamed({"base": "target"}).withColumn("url", F.col("page")))
    start = F.when(F.col("target") != "", F.coalesce("to", "page")).otherwise(F.col("page"))
    found = with_target_url(bases.select("page", start.alias("url"), F.col("link").alias("target")))
    return node_edges(found.select(F.col("page").alias("a"), F.col("to").alias("b")))


def node_edges(edges: DataFrame) -> DataFrame:
    """Edges between absolute urls as edges between their nodes, stored, as a filter on them would repeat their expressions."""
    left = with_url_parts(edges, F.col("a")).select(F.col("node").alias("na"), "b")
    return stored(with_url_parts(left, F.col("b")).select(F.col("na").alias("a"), F.col("node").alias("b")), "url-edges")


def judge_urls(pages: DataFrame, rules: list[Rule], edges: DataFrame | None = None) -> DataFrame:
    """A verdict for every row of ``pages(page_id, url, html)``: (page_id, host, path, rule, verdict, alias_root).

    A url's own longest rule decides. A url without one takes the decision of its aliases, the urls connected to it by
    redirects and canonical links: allow if a rule allows one of them, else block if a rule blocks one, else allow.
    ``alias_root`` names the group of aliases and is null for a url without any; targets that are no pages themselves count as members.
    ``edges`` (a, b) may bring further redirects, such as a crawler's log, between absolute urls.

    Null urls and urls without ``://`` have empty host and path, no rule and no aliases, and are allowed. Null html has no
    links. Repeated rows and repeated ids each get their row; other columns are ignored. Only DataFrame functions run.
    """
    found = alias_edges(pages)
    if edges is not None:
        found = found.union(node_edges(edges.select("a", "b")))
    roots = components(found)
    named = with_url_parts(pages.select("page_id", "url"), F.col("url"))
    ruled = named.withColumn("own", own_rule(F.col("host"), F.col("path"), rules))
    members = with_url_parts(roots.withColumnRenamed("node", "member"), F.concat(F.lit("x://"), F.col("member")))
    by_root = (
        members.withColumn("own", own_rule(F.col("host"), F.col("path"), rules)["verdict"])
        .groupBy("root")
        .agg(F.max(F.col("own") == "allow").alias("allowed"), F.max(F.col("own") == "block").alias("blocked"))
    )
    decided = F.when(F.coalesce("allowed", F.lit(False)), "allow").when(F.coalesce("blocked", F.lit(False)), "block").otherwise("allow")
    groups = roots.join(by_root, "root").select("node", "root", decided.alias("by_alias"))
    return ruled.join(groups, "node", "left").select(
        "page_id",
        "host",
        "path",
        F.col("own.rule").alias("rule"),
        F.coalesce("own.verdict", "by_alias", F.lit("allow")).alias("verdict"),
        F.col("root").alias("alias_root"),
    )
