"""URL verdicts by rules and by a list of URLs, behind a blocked Bloom filter."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmill.columns import col
from newsmill.llm.bloom import Filter
from newsmill.session import cut

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the query.
RULES = (
    Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"),
)
# Labels of the hosts whose pages the query lists.
LISTED_LABELS = ("cheap-pills", "casino-win", "spam-farm", "free-bets", "ads-track", "adult-x")


def _after(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))


def host(url: Column) -> Column:
    """From after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(_after(url), r"\A([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_after(url), r"\A[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host_col: Column, path_col: Column, rules: Sequence[Rule]) -> Column:
    """Number of the longest rule that fits a host (or a parent of it) and the beginning of a path."""
    found = F.lit(None).cast("int")
    for number, rule in sorted(enumerate(rules), key=lambda r: (len(r[1].text), r[1].text)):
        fits = ((host_col == rule.host) | F.endswith(host_col, F.lit("." + rule.host))) & F.startswith(path_col, F.lit(rule.path))
        found = F.when(fits, F.lit(number)).otherwise(found)
    return found


def canonical(host_col: Column, path_col: Column) -> Column:
    """Host without a leading ``www.`` and usual port, and path without an ending slash: what schemes,
    queries and fragments of one page have in common. NULL without a host."""
    bare = F.regexp_replace(host_col, r"\Awww\.|:(80|443)\z", "")
    return F.when(host_col != "", F.concat(bare, F.regexp_replace(path_col, r"/+\z", "")))


def judge(pages: DataFrame, listed_urls: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "page_id", url_col: str = "url", listed_col: str = "url") -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``canonical``, ``listed``, one row per input row.

    The longest fitting rule decides; without one a page is blocked if its canonical URL is listed. Pages
    that a blocked Bloom filter (bounded in size, broadcast) rules out are not shuffled; the others go
    through a hash join with the list itself, so that no false positive is blocked.

    A NULL URL or one without ``://`` has an empty host and path, fits no rule, is in no list: allowed.
    Repeated pages and list entries do not multiply rows; ids may be NULL; further columns are ignored.
    """
    named = canonical(host(col(listed_col)), path(col(listed_col)))
    entries = cut(listed_urls.select(named.alias("canonical")).where("canonical IS NOT NULL").distinct())
    rows = pages.select(col(id_col).alias("page_id"), host(col(url_col)).alias("host"), path(col(url_col)).alias("path"))
    rows = rows.withColumns({"n": rule_for(F.col("host"), F.col("path"), rules), "canonical": canonical(F.col("host"), F.col("path"))})
    tested = Filter(entries, "canonical").mark(rows, F.col("canonical"), "possible")
    no = tested.where(~F.col("possible")).withColumn("listed", F.lit(False))
    yes = tested.where("possible").join(entries.withColumn("listed", F.lit(True)), "canonical", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    names, verdicts = F.array(*[F.lit(r.text) for r in rules]), F.array(*[F.lit(r.verdict) for r in rules])
    both = no.unionByName(yes)
    by_rule = F.when(F.col("n").isNotNull(), F.get(verdicts, F.col("n")))
    verdict = F.coalesce(by_rule, F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow")))
    rule = F.when(F.col("n").isNotNull(), F.get(names, F.col("n")))
    return both.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "canonical", "listed")


def listed_pages(pages: DataFrame, labels: Sequence[str] = LISTED_LABELS, url_col: str = "url") -> DataFrame:
    """The URLs of pages on hosts with one of the given labels."""
    dotted = F.concat(F.lit("."), host(F.col("url")), F.lit("."))
    listed = reduce(or_, [F.contains(dotted, F.lit(f".{label}.")) for label in labels])
    return pages.select(col(url_col).alias("url")).where(listed)


_PARTS = """
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages)
"""
SQL = f"""
WITH p AS ({_PARTS}),
c AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(regexp_replace(host, '^www\\.', ''), ':(80|443)$', '') || regexp_replace(path, '/+$', '') END AS canonical FROM p),
l AS (SELECT DISTINCT canonical FROM c WHERE regexp_matches('.' || host || '.', '\\.({"|".join(LISTED_LABELS)})\\.')),
r(verdict, h, q) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
f AS (
  SELECT c.*, canonical IS NOT NULL AND canonical IN (SELECT canonical FROM l) AS listed,
    (SELECT max_by(struct_pack(v := verdict, t := h || q), length(h || q)) FROM r WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q)) AS best
  FROM c
)
SELECT page_id, host, path, best.t AS rule, coalesce(best.v, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, canonical, listed FROM f
"""
