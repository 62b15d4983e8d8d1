"""URL filtering by host and path rules, with decisions carried over redirects and canonical links.

A rule fits its host and all its subdomains where the path starts with the rule's; of several the longest wins, then the one with
the longer host, then an allowing one. Addresses that are tied by redirects or canonical links are one class: the connected
components of the graph of these links, found by rounds of joins. An address that a rule fits keeps the rule's verdict. The
others take their class's: allowed if the class holds an explicitly allowed address, else blocked if it holds
a blocked one, else allowed. So a block reaches every alias, and an explicit allow takes precedence over it.

An address is the url without scheme and fragment, its host in lower case (A-Z only), an empty path read as `/`. Links are read
from the pages' markup (`<link rel=canonical href=..>`, `<meta http-equiv=refresh content="..url=..">`, outside comments,
relative ones resolved against the page's url); redirects recorded elsewhere are passed as a table. Links to addresses that
are no page count too: two pages with the same canonical address are aliases.

A null url, or one without `://`, has an empty host and path, no rule and no address of its own: it is an alias of the first
address that its markup links to, if any. Null or empty markup has no links. Repeated rows are judged alike, null keys are kept.
An empty table gives an empty result. Columns other than the three named ones are not read.
"""

from __future__ import annotations

from functools import reduce
from html import unescape
from typing import NamedTuple
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.llm.common import staged
from tidemark.llm.components import components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A page's markup is looked at for links only if it holds one of these.
HINT = r"(?i)canonical|http-equiv"
#: Tags that may link, with their attributes in any order and quoted values that may hold `>`.
TAG = r"""(?is)<(?:link|meta)\b(?:[^>"']|"[^"]*"|'[^']*')*>"""


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: str | Column) -> Column:
    """What follows the first `://`, up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: str | Column) -> Column:
    """What follows the host, up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def address_of(url: str | Column) -> Column:
    """The url without scheme and fragment; null if it has no host part."""
    rest = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^#]*)", 1)
    return F.when(F.contains(url, F.lit("://")), F.concat(host_of(url), F.when(F.startswith(rest, F.lit("/")), rest).otherwise(F.concat(F.lit("/"), rest))))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The name of the rule that wins, or null."""
    order = sorted(rules, key=lambda r: (-len(r.name), -len(r.host), r.verdict != "allow"))
    dotted = F.concat(F.lit("."), host)
    fits = [(F.endswith(dotted, F.lit(f".{r.host}")) & F.startswith(path, F.lit(r.path)), F.lit(r.name)) for r in order]
    return F.coalesce(*[F.when(*f) for f in fits], F.lit(None).cast("string"))


def verdict_of(rule: Column, rules: list[Rule]) -> Column:
    """The verdict of a rule by its name; null without one. Of rules with one name an allowing one counts."""
    verdicts = {r.name: r.verdict for r in sorted(rules, key=lambda r: r.verdict == "allow")}
    return F.coalesce(*[F.when(rule == name, F.lit(v)) for name, v in verdicts.items()], F.lit(None).cast("string"))


@F.pandas_udf(StringType())
def _resolved(base: pd.Series, link: pd.Series) -> pd.Series:
    def one(b, href):
        try:
            return urljoin(b or "", unescape(href).strip())
        except ValueError:  # not an address
            return None

    return pd.Series([None if h is None else one(b, h) for b, h in zip(base, link)], dtype=object)


def _attribute(tag: Column, name: str) -> Column:
    """An attribute's value, quoted or bare; empty if there is none."""
    at = rf"(?is)[\s\"'/]{name}\s*=\s*"
    # Both quotes, then the bare form: only one of the groups holds a value.
    return F.regexp_replace(F.regexp_extract(tag, at + r"""("[^"]*"|'[^']*'|[^\s"'>]+)""", 1), r"""^["']|["']$""", "")


def hrefs_of(html: Column) -> Column:
    """What the markup names as canonical or refreshes to, as written; null if it has no such tags."""
    plain = F.regexp_replace(html, r"(?s)<!--.*?-->", "")

    def href(tag: Column) -> Column:
        canonical = F.rlike(tag, F.lit(r"(?is)^<link\b")) & F.rlike(_attribute(tag, "rel"), F.lit(r"(?i)(^|\s)canonical(\s|$)"))
        refresh = F.rlike(tag, F.lit(r"(?is)^<meta\b")) & (F.lower(F.trim(_attribute(tag, "http-equiv"))) == "refresh")
        to = F.regexp_extract(_attribute(tag, "content"), r"""(?is)^[\s\d.]*[;,]\s*url\s*=\s*["']?([^"']*)""", 1)
        return F.when(canonical, _attribute(tag, "href")).when(refresh, to)

    found = F.filter(F.transform(F.regexp_extract_all(plain, F.lit(TAG), F.lit(0)), href), lambda h: h != "")
    return F.when(F.rlike(html, F.lit(HINT)), F.nullif(found, F.array().cast("array<string>")))


def judge(pages: DataFrame, rules: list[Rule], redirects: DataFrame | None = None, key: str = "page_id", url: str = "url",
          html: str = "html") -> DataFrame:
    """One row per page: key, host, path, rule, verdict, aliased (whether the verdict came over links).

    `redirects`: urls in columns (source, target), recorded elsewhere.
    """
    # Written once: the numbers of the rows hold within one reading only.
    read = staged(pages.select(F.monotonically_increasing_id().alias("_row"), F.col(f"`{key}`").alias("_key"), F.col(f"`{url}`").alias("_url"),
                               hrefs_of(F.col(f"`{html}`")).alias("_hrefs")), "pages")
    links = read.where("_hrefs is not null").select("_row", "_url", F.explode("_hrefs").alias("_href"))
    links = links.select("_row", address_of(_resolved("_url", "_href")).alias("target")).where("target is not null")
    linked = staged(links.groupBy("_row").agg(F.sort_array(F.collect_set("target")).alias("_links")), "links")
    host, path = host_of("_url"), path_of("_url")
    judged = read.select("_row", "_key", host.alias("host"), path.alias("path"), address_of("_url").alias("_address"))
    own = staged(judged.join(linked, "_row", "left").withColumn("_address", F.coalesce("_address", F.col("_links")[0]))
                 .withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)), "pages")
    pairs = [own.where("_links is not null").select(F.col("_address").alias("x"), F.explode("_links").alias("y"))]
    if redirects is not None:
        pairs.append(redirects.select(address_of("source").alias("x"), address_of("target").alias("y")))
    known = staged(reduce(DataFrame.unionAll, pairs).where("x is not null and y is not null and x != y").distinct(), "links")
    roots = components(known.select(F.md5("x").alias("a"), F.md5("y").alias("b")))
    # A page without an address of its own may be the only one that names its target: no link then, but an alias.
    named = own.where("_links is not null").select("_address")
    addresses = known.select(F.explode(F.array("x", "y")).alias("_address")).unionAll(named).distinct()
    at = F.concat(F.lit("s://"), F.col("_address"))
    ruled = addresses.withColumn("own", verdict_of(rule_of(host_of(at), path_of(at), rules), rules)).withColumn("node", F.md5("_address"))
    members = staged(ruled.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "links")
    classes = members.groupBy("root").agg(F.bool_or(F.col("own") == "allow").alias("allowed"), F.bool_or(F.col("own") == "block").alias("blocked"))
    passed = F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block")
    carried = members.join(classes, "root").select("_address", passed.alias("_carried")).where("_carried is not null")
    mine = verdict_of(F.col("rule"), rules)
    return (own.join(carried, "_address", "left")
            .select(F.col("_key").alias(key), "host", "path", "rule", F.coalesce(mine, "_carried", F.lit("allow")).alias("verdict"),
                    (mine.isNull() & F.col("_carried").isNotNull()).alias("aliased")))
