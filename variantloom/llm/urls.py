"""URL filters by token-indexed pattern rules, in DataFrame operations alone.

Each rule is a regular expression with literal tokens that any url it fits must hold as whole tokens. A rule is filed under
the rarest of them. A url's tokens fetch the rules filed under them from a hashed index, and only these run. The index is
made from a table of the rules and reaches the urls' tasks as one value, so that a plan doesn't grow with the rules."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C
from .rules import let

TOKEN_SPLIT = "[^a-z0-9]+"


@dataclass(frozen=True)
class Rule:
    """target: what the pattern is run on (`url`, lower-cased, or `site`: host, a slash-led path). rank: the largest decides."""

    name: str | None
    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    rank: int
    target: str = "url"
    other: tuple[str, ...] = ()  # tokens of a second way to fit the pattern; the rule is filed under the rarest of each


def path_rule(verdict: str, rule: str) -> Rule:
    """host/path: fits the host and all its subdomains where the path starts with the rule's. The longest wins, allow before block."""
    host, slash, path = rule.partition("/")
    inner = (slash + path).split("/")[1:-1]  # parts with a slash on either side are whole tokens
    tokens = [t for t in re.split(TOKEN_SPLIT, "/".join([host, *(x.lower() for x in inner if x == x.lower())])) if t]
    return Rule(rule, rf"^(?:[^/]*\.)?{re.escape(host)}(?={re.escape(slash + path)})".replace("(?=)", r"(?=/|\z)"), tuple(tokens), verdict, 1000 + 2 * len(rule) + (verdict == "allow"), "site")


def word_rule(pattern: str, *tokens: str, verdict: str = "block", other: tuple[str, ...] = ()) -> Rule:
    """A pattern of the method's own, without a name in the result: any listed rule outranks it."""
    return Rule(None, pattern, tokens, verdict, 1, other=other)


#: The rules that the query lists.
LISTED = (path_rule("block", "com/en/"), path_rule("allow", "example.com/en/7"), path_rule("allow", "net/de/"), path_rule("block", "example.net/de/8"), path_rule("block", "org/es/"))
#: Rules of the method itself: spam, gambling, adult, shop and advertising words as whole tokens of the host.
OWN = (
    word_rule(r"^[a-z][a-z0-9+.-]*://[^/?#]*\bspam[-.]", "spam"), word_rule(r"^[a-z][a-z0-9+.-]*://[^/?#]*\bcheap-pills\b", "cheap", "pills"), word_rule(r"^[a-z][a-z0-9+.-]*://[^/?#]*\bcasino\b", "casino"),
    word_rule(r"^[a-z][a-z0-9+.-]*://[^/?#]*\b(?:free-)?porn\b", "porn"), word_rule(r"^[a-z][a-z0-9+.-]*://[^/?#]*\badult\b", "adult"), word_rule(r"^[a-z][a-z0-9+.-]*://[^/?#]*\bxxx\b", "xxx"),
    word_rule(r"^[a-z][a-z0-9+.-]*://[^/?#]*\bbets\b", "bets"), word_rule(r"^[a-z][a-z0-9+.-]*://[^/?#]*\bpoker\b", "poker"), word_rule(r"^[a-z][a-z0-9+.-]*://[^/?#]*\bads-track\b", "ads", "track"),
    word_rule(r"^[a-z][a-z0-9+.-]*://[^/?#]*\bclick-?bait\b", "clickbait", other=("click", "bait")),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty for a null or a url without `://`."""
    url = F.coalesce(url, F.lit(""))
    at = F.locate("://", url)
    after = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(after, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


#: Beyond so many rules the index would be too large to give to every task.
MOST_RULES = 2_000_000
RULE = "tokens array<string>, pattern string, site boolean, name string, verdict string, rank int"


def rule_table(spark: SparkSession, rules: tuple) -> DataFrame:
    """One row for each set of tokens that a rule is to be filed under."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MOST_RULES} fit an index")
    for r in rules:
        if not r.tokens:
            raise ValueError(f"a rule needs a literal token: {r.pattern}")
    rows = [(sorted(set(tokens)), r.pattern, r.target == "site", r.name, r.verdict, r.rank) for r in rules for tokens in ((r.tokens, r.other) if r.other else (r.tokens,))]
    return spark.createDataFrame(rows, RULE)


def token_counts(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """(t, n): in how many rows each token that a rule names occurs. The named tokens are as many as the rules' at most, and are given to every task."""
    named = rules.select(F.explode("tokens").alias("t")).distinct()
    tokens = urls.select(F.explode(F.array_distinct(F.split(F.lower(F.coalesce(url, F.lit(""))), TOKEN_SPLIT))).alias("t"))
    return tokens.join(F.broadcast(named), "t").groupBy("t").agg(F.count("*").alias("n"))


def index(rules: DataFrame, counts: DataFrame, n_rules: int) -> tuple[Column, int]:
    """The index as one value, an array of buckets, and their number; each holds the rules (token, pattern, site, name, verdict, rank) whose rarest token hashes there."""
    size = 1 << max(3, (2 * n_rules).bit_length())
    each = rules.withColumn("rule", F.monotonically_increasing_id()).select("*", F.explode("tokens").alias("t")).join(counts, "t", "left")
    entry = F.struct(F.col("t").alias("token"), "pattern", "site", "name", "verdict", "rank")
    filed = each.groupBy("rule").agg(F.min_by(entry, F.struct(F.coalesce("n", F.lit(0)).alias("n"), "t")).alias("e"))
    buckets = filed.groupBy(_bucket(F.col("e.token"), size).alias("bucket")).agg(F.sort_array(F.collect_list("e")).alias("entries"))
    every = rules.sparkSession.range(size).select(F.col("id").cast("int").alias("bucket")).join(buckets, "bucket", "left")
    listed = F.array_sort(F.collect_list(F.struct("bucket", F.coalesce("entries", F.filter(F.array(F.lit(None).cast(_ENTRY)), lambda e: e.isNotNull())).alias("entries"))))
    return every.agg(F.transform(listed, lambda x: x["entries"]).alias("filed")).scalar(), size


_ENTRY = "struct<token:string,pattern:string,site:boolean,name:string,verdict:string,rank:int>"


def _bucket(token: Column, size: int) -> Column:
    return F.pmod(F.crc32(token.cast("binary")), F.lit(size)).cast("int")


def judge(urls: DataFrame, rules: tuple = LISTED + OWN, url: str = "url", default: str = "allow") -> DataFrame:
    """The rows with host, path, rule (the deciding rule's name; null for the method's own or none) and verdict.

    A null url, or one without `://`, has neither host nor path, and no listed rule fits it. Repeated rows are judged each,
    very long urls whole. Columns named host, path, rule or verdict are replaced; any others stay as they are. An empty
    table gives no rows. The index grows with the rules, of which there are at most MOST_RULES, never with the urls."""
    table = rule_table(urls.sparkSession, rules)
    held, size = index(table, C.stash(token_counts(urls, table, url), "tokens"), len(rules))
    keep = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict")]
    filed, best = C.fresh(urls.columns + ["host", "path", "rule", "verdict"], "filed", "best")
    host, path = url_parts(C.column(url))
    rows = urls.select(*map(C.column, keep), host.alias("host"), path.alias("path"), held.alias(filed))
    low = F.lower(F.coalesce(C.column(url), F.lit("")))

    def fits(u: Column) -> Column:
        fetched = F.flatten(F.transform(u["tokens"], lambda t: F.filter(F.get(F.col(filed), _bucket(t, size)), lambda r: r["token"] == t)))
        hits = F.filter(fetched, lambda r: F.call_function("rlike", F.when(r["site"], u["where"]).otherwise(u["url"]), r["pattern"]))
        return F.array_max(F.transform(hits, lambda r: F.struct(r["rank"].alias("rank"), r["name"].alias("name"), r["verdict"].alias("verdict"))))

    found = let(F.struct(F.array_distinct(F.split(low, TOKEN_SPLIT)).alias("tokens"), F.concat("host", "path").alias("where"), low.alias("url")), fits)
    return rows.select(*map(C.column, keep), "host", "path", found.alias(best)).select(*map(C.column, keep), "host", "path", F.col(f"{best}.name").alias("rule"), F.coalesce(F.col(f"{best}.verdict"), F.lit(default)).alias("verdict"))
