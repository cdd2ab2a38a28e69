"""URL filters whose block decisions reach the aliases of a page."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.components import components
from larkspur.session import materialize

#: action, host, path. Fixed values.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
CANONICAL = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
TARGET = r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)"""
BASE = r"""(?is)<base\b[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
AMPERSAND = r"(?i)&(amp|#0*38|#x0*26);"
# Query parameters that do not change what a page shows.
TRACKING = r"(^|&)(utm_[^=&]*|ref|fbclid|gclid)(=[^&]*)?"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?`` or ``#``; A-Z in lower case."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, ascii_uppercase, ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _folded(path: Column) -> Column:
    """Path without ``.`` and ``..`` segments; ``..`` does not lead above the host."""
    none = F.expr("cast(array() as array<string>)")
    steps = F.aggregate(
        F.split(path, "/"), none,
        lambda kept, step: F.when(step == ".", kept)
        .when(step == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(1))))
        .otherwise(F.concat(kept, F.array(step))),
    )
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.array_join(steps, "/")).otherwise(path)


def alias_key(url: Column) -> Column:
    """One name for the addresses that show the same page; null without a host.

    The scheme, the fragment, tracking parameters, ``.`` and ``..`` segments and closing
    slashes do not count.
    """
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(F.regexp_replace(query, TRACKING, ""), "^&+", "")
    path = F.regexp_replace(_folded(path_of(url)), "/+$", "")
    key = F.concat(host_of(url), path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))
    return F.when(host_of(url) != "", key)


def resolve(target: Column, page: Column) -> Column:
    """Absolute address of a link on a page; null for other schemes than http and https."""
    base, path = F.concat(F.lit("http://"), host_of(page)), path_of(page)
    folder = F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, "[^/]*$", ""))
    return (
        F.when(target.rlike(r"^(?i)https?://"), target)
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(target.startswith("/"), F.concat(base, target))
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(target.startswith("?"), F.concat(base, path, target))
        .when(target.startswith("#"), page)
        .otherwise(F.concat(base, folder, target))
    )


def explicit_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (rule, action) of the longest rule that fits, or null.

    The list is part of the plan, one branch a rule: it is meant for the short list a
    person writes.
    """
    chosen = None
    for action, name, prefix in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        value = F.struct(F.lit(name + prefix).alias("rule"), F.lit(action).alias("action"))
        chosen = F.when(fits, value) if chosen is None else chosen.when(fits, value)
    empty = F.lit(None).cast("struct<rule:string,action:string>")
    return empty if chosen is None else chosen


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once and standing once in the plan."""
    return F.get(F.transform(F.array(value), use), 0)


def _links(tag: str, address: str) -> Column:
    """Addresses in all tags of a kind."""
    found = F.regexp_extract_all("html", F.lit(tag), F.lit(0))
    return F.transform(found, lambda x: F.regexp_extract(x, address, 1))


def alias_edges(pages: DataFrame) -> DataFrame:
    """(a, b): keys joined by a canonical link or by a redirect in the page.

    All such tags count. Relative links start at the page, or at its first base address.
    """
    def plain(address: Column) -> Column:
        return F.regexp_replace(address, AMPERSAND, "&")

    def start(base: Column) -> Column:
        return F.coalesce(F.when(base != "", resolve(base, F.col("url"))), F.col("url"))

    def keys(targets: Column) -> Column:
        return _once(_once(plain(F.regexp_extract("html", BASE, 1)), start), lambda page: F.transform(
            F.filter(targets, lambda x: x != ""), lambda x: _once(plain(x), lambda x: _once(resolve(x, page), alias_key))
        ))

    targets = F.concat(_links(CANONICAL, HREF), _links(REFRESH, TARGET))
    aimed = _once(targets, lambda x: F.when(F.size(x) > 0, keys(x)))
    found = pages.select(alias_key(F.col("url")).alias("a"), F.explode(aimed).alias("b"))
    return found.where("a is not null and b is not null and a != b")


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of (page_id, url, html).

    A page with a rule of its own keeps that verdict. Any other page takes it from its
    aliases, the pages in one component of canonical links, redirects and equal keys:
    allow where a rule allows one of them, else block where a rule blocks one, else
    allow. Decisions are counted by key before they move, so a key or component that
    owns a third of the pages costs one row per task.

    Null or malformed urls have empty host and path, no aliases, and are allowed; null
    html has no links. Repeated rows are judged each. Empty table: no rows. Other
    columns are not read.
    """
    own = explicit_rule(F.col("host"), F.col("path"), rules)
    base = pages.select(
        "page_id",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        alias_key(F.col("url")).alias("key"),
    ).withColumn("own", own)
    base = base.select("page_id", "host", "path", "key", "own.rule", "own.action")
    labels = components(alias_edges(pages))

    decided = base.where("action is not null and key is not null")
    by_key = decided.groupBy("key").agg(F.min("action").alias("action"))  # allow before block
    named = by_key.join(labels.withColumnRenamed("id", "key"), "key", "left")
    by_group = (
        named.groupBy(F.coalesce("label", "key").alias("label"))
        .agg(F.min("action").alias("alias_action"))
    )
    open_keys = base.where("action is null and key is not null").select("key").distinct()
    groups = open_keys.join(labels.withColumnRenamed("id", "key"), "key", "left")
    groups = groups.select("key", F.coalesce("label", "key").alias("label"))
    passed = groups.join(by_group, "label").select("key", "alias_action")
    joined = base.join(passed, "key", "left")
    verdict = F.coalesce("action", "alias_action", F.lit("allow"))
    return joined.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
