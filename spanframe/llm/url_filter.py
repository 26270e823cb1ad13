"""URL filters with redirect equivalence.

Rules name a host (with all its subdomains) and a path prefix; the longest
rule that fits a url decides it.  Urls that are aliases of one another, by
redirects, canonical links, refreshes or equivalent spellings, share their
decision: block rules reach every alias, but an explicit allow comes first,
both on the url itself and among its aliases.

Aliases are connected components over the link edges, computed by a
distributed star contraction; urls, rules and components meet in equi-joins.
"""

from __future__ import annotations

from dataclasses import dataclass
from html import unescape
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import materialise, packed, unpacked
from .components import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# query parameters that do not select content
TRACKING = r"^(utm_[^=]*|ref|gclid|fbclid|sessionid)(=.*)?$"


@dataclass(frozen=True)
class Rule:
    verdict: str  # "allow" or "block"
    host: str
    path: str


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    return spark.createDataFrame([(r.verdict, r.host, r.path) for r in rules],
                                 "verdict string, host string, path string")


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """Host, A-Z lower-cased; empty for a null url or one without ``://``."""
    host = F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """Path from the host's end up to ``?``, ``#`` or the end; empty like the host."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def spelling(url: Column) -> Column:
    """The url without what does not change the page: scheme, ``www.``, default port,
    fragment, tracking parameters, the order of parameters and a final slash."""
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":(80|443)$", "")
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.rlike(p, F.lit(TRACKING))))
    params = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(_rest(url).isNull(), url) \
        .otherwise(F.concat(host, F.regexp_replace(path_of(url), "/+$", ""), params))


@F.pandas_udf(StringType())
def absolute(base: pd.Series, link: pd.Series) -> pd.Series:
    """``link`` as found on the page ``base``, resolved by RFC 3986; null unless the result is a web address."""
    def joined(b: str | None, x: str | None) -> str | None:
        if not b or not x:
            return None
        try:
            found = urljoin(b, unescape(x).strip())
        except ValueError:  # a malformed host names no page
            return None
        return found if found[:8].lower().startswith(("http://", "https://")) else None

    return pd.Series([joined(b, x) for b, x in zip(base, link)], dtype=object)


def _attribute(tag: Column, name: str) -> Column:
    """Value of an attribute, quoted either way or bare; empty where the tag has none."""
    pattern = rf"""(?is)\s{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    return F.concat(*[F.regexp_extract(tag, pattern, g) for g in (1, 2, 3)])


def _tags(html: Column, name: str, attribute: str, word: str) -> Column:
    """All tags ``name`` whose ``attribute`` holds ``word``."""
    value = rf"""(?:"[^">]*\b{word}\b|'[^'>]*\b{word}\b|{word}\b)"""
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{name}\s(?:[^>]*\s)?{attribute}\s*=\s*{value}[^>]*>"), F.lit(0))


def page_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(from_url, to_url): canonical links, og:url and refreshes that a page states.

    All such tags of a page count.  Relative links are resolved against the
    page's first ``<base href>``, else its url.  Null urls and texts, texts
    without such tags, empty targets and targets that are no web address state
    nothing; repeated pages state their links again; an empty table has none.
    """
    url, html = F.col(url_col), F.col(html_col)
    found = F.concat(
        F.transform(_tags(html, "link", "rel", "canonical"), lambda t: _attribute(t, "href")),
        F.transform(_tags(html, "meta", "property", "og:url"), lambda t: _attribute(t, "content")),
        F.transform(_tags(html, "meta", "http-equiv", "refresh"), lambda t: F.regexp_extract(
            _attribute(t, "content"), r"(?is)\burl\s*=\s*[\"']?([^\"'\s]+)", 1)))
    base = _attribute(F.regexp_extract(html, r"(?is)<base\s[^>]*>", 0), "href")
    d = pages.filter(url.isNotNull() & html.isNotNull()).select(url.alias("from_url"), base.alias("base"), F.explode(
        F.array_distinct(F.filter(found, lambda x: x != ""))).alias("link"))
    root = F.when(F.col("base") == "", F.col("from_url")).otherwise(
        F.coalesce(absolute(F.col("from_url"), F.col("base")), F.col("from_url")))
    return d.withColumn("root", root).select("from_url", absolute(F.col("root"), F.col("link")).alias("to_url")) \
        .filter(F.col("to_url").isNotNull())


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (url, host, path) with ``rule`` (host + path) and ``rule_verdict``; null where none fits.

    The longest rule wins; of equal ones an allow, then the first by text.
    Each url is looked up under its host's suffixes and the prefixes of its
    path that are as long as some rule's path, so lookups are exact matches.
    """
    n = F.length("path")
    lengths = [r[0] for r in rules.select(n).distinct().collect()]  # at most the length of the longest path
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.array(*[F.when(n >= k, F.substring("path", 1, k)) for k in sorted(lengths)]) if lengths \
        else F.array().cast("array<string>")
    keys = urls.filter(F.col("host") != "").select("url", F.explode(suffixes).alias("r_host"),
                                                   F.array_distinct(F.array_compact(prefixes)).alias("p")) \
        .select("url", "r_host", F.explode("p").alias("r_path"))
    r = rules.select(F.col("host").alias("r_host"), F.col("path").alias("r_path"), "verdict")
    text = F.concat("r_host", "r_path")
    best = keys.join(r, ["r_host", "r_path"]).groupBy("url").agg(
        F.min_by(F.struct(text.alias("rule"), F.col("verdict")), F.struct(
            -F.length(text), F.col("verdict") != "allow", text)).alias("best"))
    return urls.join(best.select("url", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("rule_verdict")),
                     "url", "left")


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None, url_col: str = "url",
          html_col: str | None = "html") -> DataFrame:
    """``pages`` with ``_host``, ``_path``, ``_rule``, ``_alias`` and ``_verdict``.

    ``rules`` has (verdict, host, path); ``redirects`` may add (from_url,
    to_url) seen by the crawler.  ``_alias`` names the component of the url.  A
    url's own rule decides it; else its aliases do: allow if one of them is
    allowed by rule, block if one is blocked, allow otherwise.

    A null url, or one without ``://``, has an empty host, fits no rule and is
    an alias of itself only (a null one of nothing), hence allowed.  Repeated
    urls are judged once and alike.  All columns of ``pages`` stay, but for
    those named like the new ones; an empty table stays empty.
    """
    links = page_links(pages, url_col, html_col) if html_col else None
    if redirects is not None:
        seen = redirects.select("from_url", "to_url")
        links = seen if links is None else links.unionByName(seen)
    urls = pages.select(F.col(url_col).alias("url"))
    if links is not None:
        links = materialise(links.filter(F.col("from_url").isNotNull() & F.col("to_url").isNotNull()).distinct())
        # the ends of links carry decisions even where no page was fetched
        urls = urls.unionByName(links.select(F.col("from_url").alias("url"))) \
            .unionByName(links.select(F.col("to_url").alias("url")))
    urls = urls.filter(F.col("url").isNotNull()).distinct()
    urls = urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                       spelling(F.col("url")).alias("node"))
    urls = materialise(match_rules(urls, rules))
    if links is not None:
        roots = components(links.select(spelling(F.col("from_url")).alias("u"), spelling(F.col("to_url")).alias("v")))
        urls = urls.join(roots, "node", "left").withColumn("alias", F.coalesce("root", "node")).drop("root")
    else:
        urls = urls.withColumn("alias", F.col("node"))
    shared = urls.filter(F.col("rule_verdict").isNotNull()).groupBy("alias") \
        .agg(F.min("rule_verdict").alias("shared"))  # "allow" comes before "block"
    verdicts = urls.join(shared, "alias", "left").withColumn("verdict", F.coalesce("rule_verdict", "shared", F.lit("allow")))
    return unpacked(packed(pages, url=url_col).join(verdicts, "url", "left"), pages.columns,
                    _host=F.coalesce("host", F.lit("")), _path=F.coalesce("path", F.lit("")), _rule=F.col("rule"),
                    _alias=F.col("alias"), _verdict=F.coalesce("verdict", F.lit("allow")))
