"""URL filters: rules by host and path, spread to the aliases of a blocked page. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import staged
from tallyloom.llm.components import connected_components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\bcontent\s*=\s*["'][^"']*?\burl\s*=\s*([^"'\s>]+)"""


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def _once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """``df`` with one more column. It is exploded from an array of one, so expressions on it don't repeat what it is made of."""
    return df.select(*df.columns, F.explode(F.array(value)).alias(name))


def with_address(df: DataFrame, url: str, name: str) -> DataFrame:
    """``df`` with a struct of the parts of an address: ``site`` as written, ``host`` (A-Z lower-cased), ``path`` and ``node``.

    The node is one name for the forms of an address that reach the same page: host, path and query; null without a host.
    """
    rest = _once(df, _rest(F.col(url)), "_rest")
    parts = F.struct(
        F.coalesce(F.regexp_extract("_rest", r"^([^/?#]*)", 1), F.lit("")).alias("site"),
        F.coalesce(F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1), F.lit("")).alias("path"),
        F.coalesce(F.regexp_extract("_rest", r"^[^?#]*(\?[^#]*)", 1), F.lit("")).alias("query"),
        F.translate(F.coalesce(F.regexp_extract("_rest", r"^([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER).alias("host"),
    )
    cut = _once(rest, parts, "_parts").drop("_rest")
    path = F.when(F.col("_parts.path") == "", "/").otherwise(F.col("_parts.path"))
    node = F.when(F.col("_parts.host") != "", F.concat("_parts.host", path, "_parts.query"))
    return cut.withColumn(name, F.struct("_parts.site", "_parts.host", "_parts.path", node.alias("node"))).drop("_parts")


def rules_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """``rule, action`` for a list as in ``[("example.com/de/", "block")]``."""
    return spark.createDataFrame(rules, "rule string, action string")


def decide(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (with ``host``, ``path``) and the ``rule`` and ``action`` of the longest rule that fits, or nulls.

    A rule is a host and a path. It fits the host and all its subdomains where the path starts with the rule's; of two
    rules of equal length allow comes first. Rules are looked up once per distinct host by its suffixes.
    """
    parsed = rules.filter("rule is not null").select(
        F.translate(F.regexp_extract("rule", r"^([^/]*)", 1), _UPPER, _LOWER).alias("suffix"),
        F.struct(
            F.length("rule").alias("size"), (F.col("action") == "allow").alias("allow"), F.col("rule"),
            F.regexp_extract("rule", r"^[^/]*(.*)$", 1).alias("start"),
        ).alias("found"),
    )
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    hosts = urls.select("host").filter("host <> ''").distinct().withColumn("suffix", F.explode(suffixes))
    by_host = hosts.join(parsed, "suffix").groupBy("host").agg(F.collect_set("found").alias("found"))
    fitting = F.array_max(F.filter("found", lambda r: F.startswith(F.col("path"), r["start"])))
    judged = urls.join(by_host, "host", "left").withColumn("found", fitting)
    action = F.when(F.col("found.allow"), "allow").when(~F.col("found.allow"), "block")
    return judged.withColumn("rule", F.col("found.rule")).withColumn("action", action).drop("found")


def page_links(pages: DataFrame) -> DataFrame:
    """Redirect and canonical-link edges ``url, to, a, b`` between addresses that ``pages`` (``url, html``) state themselves.

    All canonical links and refresh redirects of a page count.
    """
    html = F.col("html")
    stated = pages.filter(html.rlike(r"(?i)canonical|http-equiv")).select(
        "url", F.explode(F.concat(F.regexp_extract_all(html, F.lit(_CANONICAL), F.lit(1)), F.regexp_extract_all(html, F.lit(_REFRESH), F.lit(1)))).alias("target")
    )
    stated = with_address(stated.filter("target <> ''").distinct(), "url", "from")
    target = F.regexp_replace("target", "&amp;", "&")
    scheme = F.regexp_extract("url", r"^([^:/?#]*:)", 1)
    folder = F.regexp_extract("from.path", r"^(.*/)", 1)
    absolute = (
        F.when(F.contains(target, F.lit("://")), target)
        .when(F.startswith(target, F.lit("//")), F.concat(scheme, target))
        .when(F.startswith(target, F.lit("/")), F.concat(scheme, F.lit("//"), F.col("from.site"), target))
        .otherwise(F.concat(scheme, F.lit("//"), F.col("from.site"), F.when(folder == "", "/").otherwise(folder), target))
    )
    links = with_address(_once(stated.select("url", "target", "from"), absolute, "to"), "to", "there")
    return links.select("url", "to", F.col("from.node").alias("a"), F.col("there.node").alias("b")).filter("a <> b")


def filter_urls(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages`` (``page_id, url, html``).

    A page with a rule has the verdict of its longest rule. The others are blocked if an address that redirects or
    canonical links join with theirs, over any number of steps, is blocked by a rule; an allow rule always wins for its
    own pages. ``redirects`` (``url, to``) adds to what the pages state. Null urls and such without ``://`` have an
    empty host and path, no rule and no aliases, and are allowed.
    """
    edges = page_links(pages)
    if redirects is not None:
        more = with_address(with_address(redirects.select("url", "to"), "url", "from"), "to", "there")
        edges = edges.unionByName(more.select("url", "to", F.col("from.node").alias("a"), F.col("there.node").alias("b")).filter("a <> b"))
    edges = staged(edges.distinct())
    ends = edges.select(F.col("url"), F.col("a").alias("node")).unionByName(edges.select(F.col("to").alias("url"), F.col("b").alias("node"))).distinct()
    judged = decide(with_address(ends, "url", "at").select("node", "at.host", "at.path"), rules)
    groups = staged(connected_components(edges.select("a", "b")))
    blocked = judged.filter("action = 'block'").select("node").distinct().join(groups, "node").select("component").distinct()
    aliases = groups.join(blocked, "component").select("node", F.lit(True).alias("alias"))

    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    placed = with_address(own, "url", "at").select("page_id", "at.host", "at.path", "at.node")
    found = decide(placed, rules).join(aliases, "node", "left")
    verdict = F.coalesce("action", F.when(F.col("alias"), "block"), F.lit("allow"))
    return found.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
