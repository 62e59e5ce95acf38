"""URL filter: pattern rules indexed by their rarest literal token.

A rule names a host and the beginning of a path; `*` in the path stands for any run of
characters. It fits a URL of its host or a subdomain whose path begins like the rule's.
Every rule has literal tokens (labels of its host, whole segments of its path). Spark
counts these tokens over all URLs, and each rule is filed under the one that fewest URLs
have. The tokens of a URL fetch the candidate rules, and only those run their regular
expression. Of the rules that fit the longest wins, of equally long ones the first in
code point order. A URL that no rule fits gets the default verdict.

Rules are a list in memory and sent to the tasks; more than MAX_RULES are refused.

Defined cases: a null URL and one without `://` have an empty host and path; only the
default applies. Repeated rows give equal rows; other columns are never read. Without
rules every verdict is the default.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RULES = 200_000
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
TOKEN = re.compile(r"[^./]+")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path

    def pattern(self) -> re.Pattern:
        path = ".*".join(re.escape(part) for part in self.path.split("*"))
        return re.compile(rf"(?:[^/]*\.)?{re.escape(self.host)}{path}", re.DOTALL)

    def tokens(self) -> set[str]:
        """Tokens that every URL the rule fits has."""
        whole = self.path[: self.path.rfind("/") + 1]  # the last segment may go on
        segments = [s for s in whole.split("/") if "*" not in s]
        return set(TOKEN.findall(self.host)) | {t for s in segments for t in TOKEN.findall(s)}


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path."""
    text = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(text, PARTS, 1), UPPER, LOWER)
    return host, F.regexp_extract(text, PARTS, 2)


def token_counts(places: DataFrame, rules: Sequence[Rule]) -> dict[str, int]:
    """URLs per token of the rules; at most one row per token is collected."""
    wanted = sorted({t for rule in rules for t in rule.tokens()})
    if not wanted:
        return {}
    tokens = F.array_distinct(F.split(F.concat("host", "path"), r"[./]+"))
    found = places.select(F.explode(tokens).alias("token")).where(F.col("token").isin(wanted))
    return {r["token"]: r["n"] for r in found.groupBy("token").agg(F.count("*").alias("n")).collect()}


class RuleIndex:
    """Rules by their rarest token; rules without a token are tried on every URL."""

    def __init__(self, rules: Sequence[Rule], counts: dict[str, int]) -> None:
        self.by_token: dict[str, list[tuple[Rule, re.Pattern]]] = defaultdict(list)
        self.everywhere: list[tuple[Rule, re.Pattern]] = []
        # longest first, so that the first fit of a list is its best
        for rule in sorted(set(rules), key=lambda r: (-len(r.name), r.name, r.verdict)):
            entry = (rule, rule.pattern())
            tokens = rule.tokens()
            if tokens:
                self.by_token[min(tokens, key=lambda t: (counts.get(t, 0), t))].append(entry)
            else:
                self.everywhere.append(entry)

    def winner(self, host: str, path: str) -> Rule | None:
        place, best = host + path, None
        lists = [self.by_token[t] for t in set(TOKEN.findall(place)) if t in self.by_token]
        for entries in (*lists, self.everywhere):
            for rule, pattern in entries:
                if best and (-len(rule.name), rule.name) >= (-len(best.name), best.name):
                    break
                if pattern.match(place):
                    best = rule
                    break
        return best


def judge(pages: DataFrame, rules: Sequence[Rule], default: str = "allow") -> DataFrame:
    """page_id, host, path, rule and verdict of every row of `pages` (page_id, url)."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules, more than {MAX_RULES} are not sent to tasks")
    host, path = split_url(F.col("url"))
    places = pages.select("page_id", host.alias("host"), path.alias("path"))
    index = pages.sparkSession.sparkContext.broadcast(RuleIndex(rules, token_counts(places, rules)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                index.value.winner(host, path)
                for host, path in zip(batch[1].to_pylist(), batch[2].to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([rule and rule.name for rule in found], pa.string()),
                    pa.array([rule.verdict if rule else default for rule in found], pa.string()),
                ],
                ["page_id", "host", "path", "rule", "verdict"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, host string, path string, rule string, verdict string"
    return places.mapInArrow(run, schema)
