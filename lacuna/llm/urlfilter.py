"""URL filters by pattern rules that are indexed by their rarest literal token, in DataFrame functions only.

Two kinds of rules. A site rule (host, path) fits its host and all subdomains if the URL's path
starts with the rule's; the longest wins. If no site rule fits, pattern rules decide: ``||`` stands
for a scheme and any subdomains, ``^`` for a separator or the end, ``*`` for anything, ``|`` at either
end for an anchor; an allowing pattern beats a blocking one, then the longer wins. If none fits, the
default holds.

A rule's literal tokens are its runs of letters and digits that a fitting URL must hold as whole
tokens. Each rule stands in the index under the one of them that is rarest among all URLs; a URL's
tokens fetch the rules under them, and only these and the rules without a token run their regular
expression. The index is one value for each ``GROUP`` rules, hashed by token; rows never move. More
rules than that make further groups, and the best of all groups' finds holds.

Rows: a null URL or one without ``://`` has an empty host and path and gets the default verdict
(no rule can fit an empty host; patterns see the URL as it is). Repeated rows are judged alike.
Extra columns are ignored.
"""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, functions as F

GROUP = 20_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
SEPARATOR = r"(?:[^A-Za-z0-9_.%-]|$)"
ANY_SITE = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*\.)?"

# the site rules, (action, host, path), fixed by the contract
SITE_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
              ("block", "net", "/es/"), ("block", "net", "/fr/")]

# the default patterns: pages that hold no text of their own, and copies made for feeds
PATTERN_RULES = [("block", p) for p in (
    "/wp-login.php^", "/wp-admin/", "/cgi-bin/", "/login^", "/logout^", "/signin^", "/signup^", "/register^", "/cart^",
    "/checkout^", "/basket^", "/search^", "/share^", "/print^", "/ads/", "/adserver/", "/banner/*/click^", "||doubleclick.net^",
    "||adserver.*/click^", "^sessionid=", "^phpsessid=", "^sort=*^order=", "^action=edit^", "^replytocom=", "^utm_source=feed^",
)] + [("allow", p) for p in ("||blog.*/en/", "/about^", "/archive/*.html|")]


@dataclass(frozen=True)
class Rule:
    name: str
    action: str
    regex: str
    tokens: tuple[str, ...]
    site: bool
    rank: int


def site_rule(action: str, host: str, path: str) -> Rule:
    """Tested on host and path joined."""
    text = host + path
    tokens = [m[0].lower() for m in re.finditer(r"[A-Za-z0-9]+", text) if m.end() < len(text)]
    return Rule(text, action, r"^(?:[^/]*\.)?" + _quoted(text), tuple(dict.fromkeys(tokens)), True, len(text))


def pattern_rule(action: str, pattern: str) -> Rule:
    """Tested on the whole URL, in either case."""
    body, start, end = pattern, "", ""
    if body.startswith("||"):
        body, start = body[2:], ANY_SITE
    elif body.startswith("|"):
        body, start = body[1:], "^"
    if body.endswith("|"):
        body, end = body[:-1], "$"
    regex = "".join(".*" if c == "*" else SEPARATOR if c == "^" else _quoted(c) for c in body)
    bounded = lambda c, anchored: anchored if c == "" else c != "*"
    tokens = [m[0].lower() for m in re.finditer(r"[A-Za-z0-9]+", body)
              if bounded(body[:m.start()][-1:], bool(start)) and bounded(body[m.end():][:1], bool(end))]
    return Rule(pattern, action, "(?is)" + start + regex + end, tuple(dict.fromkeys(tokens)), False, len(pattern))


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() and c.isascii() else "\\" + c if c.isascii() else c for c in text)


def default_rules() -> list[Rule]:
    return [site_rule(*r) for r in SITE_RULES] + [pattern_rule(*r) for r in PATTERN_RULES]


def lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def tokens(url: Column) -> Column:
    return F.array_distinct(F.split(lower(url), "[^a-z0-9]+"))


RULE = "name:string,action:string,regex:string,site:boolean,rank:int"


def index(pages: DataFrame, rules: list[Rule]) -> tuple[Column, int]:
    """The rules by bucket of their rarest token's hash, as one value, and the number of buckets."""
    given = F.from_json(F.lit(json.dumps([asdict(r) for r in rules])), f"array<struct<{RULE},tokens:array<string>>>")
    listed = pages.sparkSession.range(1).select(F.posexplode(given).alias("id", "r")).select("id", "r.*")
    known = listed.select(F.explode("tokens").alias("token")).distinct()  # of at most GROUP rules
    counts = (pages.select(F.explode(tokens(F.coalesce("url", F.lit("")))).alias("token")).join(F.broadcast(known), "token", "left_semi")
              .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    rare = (listed.select("id", F.explode("tokens").alias("token")).join(counts, "token", "left")
            .groupBy("id").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))["token"].alias("token")))
    n = 1
    while n < 2 * len(rules):
        n *= 2
    held = (listed.join(rare, "id", "left").withColumn("token", F.coalesce("token", F.lit("")))
            .groupBy(F.pmod(F.xxhash64("token"), F.lit(n)).alias("bucket"))
            .agg(F.collect_list(F.struct("token", "name", "action", "regex", "site", "rank")).alias("rules")))
    none = F.array().cast(f"array<struct<token:string,{RULE}>>")
    filled = pages.sparkSession.range(n).withColumnRenamed("id", "bucket").join(held, "bucket", "left").select(F.struct("bucket", F.coalesce("rules", none).alias("rules")).alias("b"))
    value = filled.agg(F.transform(F.array_sort(F.collect_list("b")), lambda b: b.rules).alias("index"))
    return value.scalar(), n


def _best(held: Column, n: int) -> Column:
    """The rule of one index that counts first, null if none fits; of rows with tokens, place and url."""
    fetched = F.flatten(F.transform("tokens", lambda t: F.filter(F.get(held, F.pmod(F.xxhash64(t), F.lit(n)).cast("int")), lambda r: r.token == t)))
    fit = F.filter(fetched, lambda r: F.regexp_like(F.when(r.site, F.col("place")).otherwise(F.col("url")), r.regex))
    return F.array_max(F.transform(fit, lambda r: F.struct(r.site.alias("site"), (r.site | (r.action == "allow")).alias("first"), r["rank"].alias("rank"),
                                                           r["name"].alias("name"), r.action.alias("action"))))


def judge(pages: DataFrame, rules: list[Rule] | None = None, default: str = "allow") -> DataFrame:
    """page_id, host, path, the site rule, the pattern and the verdict of every row."""
    rules = default_rules() if rules is None else rules
    groups = [rules[at:at + GROUP] for at in range(0, len(rules), GROUP)]
    url = F.coalesce("url", F.lit(""))
    rows = pages.select("page_id", url.alias("url"), lower(F.regexp_extract(url, URL, 1)).alias("host"), F.regexp_extract(url, URL, 2).alias("path"),
                        F.array_union(tokens(url), F.array(F.lit(""))).alias("tokens"))  # "": rules without a token
    rows = rows.withColumn("place", F.concat("host", "path"))
    best = F.lit(None).cast("struct<site:boolean,first:boolean,rank:int,name:string,action:string>")
    for i, group in enumerate(groups):
        held, n = index(pages, group)
        rows = rows.withColumn(f"held{i}", held)
        found = _best(F.col(f"held{i}"), n)
        best = F.array_max(F.array(best, found)) if i else found
    rows = rows.select("page_id", "host", "path", best.alias("best"))
    site = F.coalesce(F.col("best.site"), F.lit(False))
    return rows.select("page_id", "host", "path", F.when(site, F.col("best.name")).alias("rule"),
                       F.when(~site, F.col("best.name")).alias("pattern"), F.coalesce("best.action", F.lit(default)).alias("verdict"))
