"""URL allow and block rules in one trie over reversed host labels and path segments.

Hosts are walked from the last label (``org``, ``example``, ``www``): a rule's host fits itself and every subdomain.
Below the node of a host hangs the trie of its path segments; a rule's last, possibly unfinished segment (``/en/1``) is
compared as a prefix. The deepest host wins, then the longest path, whatever its verdict, so an allow entry can open
part of a blocked site and the other way round.

A list of up to ``max_rules`` entries is broadcast as a trie inside the compiled function. Longer ones, and lists that are tables, are joined: every
distinct URL asks for each suffix of its host, and there for its path's prefixes of those lengths that the host's rules have. Both
ways give the same rule (tested).

Nulls and oddities: a null URL, or one without ``://``, has an empty host and path, fits no rule and gets the default
verdict. Hosts are compared as written after lower-casing A-Z: ports and user names are part of them. Repeated rows are judged each; a URL of
any length is walked once by the trie. Of equal rules the first counts; one that is both allowed and blocked is an error.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rule(verdict: str, text: str) -> Rule:
    """``rule("block", "example.org/es/")``: host up to the first slash, then the path."""
    if verdict not in ("allow", "block"):
        raise ValueError(f"unknown verdict {verdict!r}")
    host, slash, path = text.partition("/")
    return Rule(host.translate(str.maketrans(_UPPER, _LOWER)), slash + path, verdict)


MAX_RULES = 100_000


class UrlTrie:
    def __init__(self, rules: list[Rule], max_rules: int = MAX_RULES):
        if len(rules) > max_rules:
            raise ValueError(f"{len(rules)} rules; this trie is broadcast and takes {max_rules}")
        self.rules = list(rules)
        # A node: children by label or segment, "paths" (root of the path trie) or the rules that end there by unfinished segment.
        self.root: dict = {}
        seen: dict[str, str] = {}
        for number, entry in enumerate(self.rules):
            if seen.setdefault(entry.text, entry.verdict) != entry.verdict:
                raise ValueError(f"{entry.text} is both allowed and blocked")
            node = self.root
            for label in reversed(entry.host.split(".")):
                node = node.setdefault(("label", label), {})
            *whole, last = entry.path.split("/")
            node = node.setdefault("paths", {})
            for segment in whole:
                node = node.setdefault(("segment", segment), {})
            ends = node.setdefault("ends", {})
            ends.setdefault(last, number)

    def find(self, host: str, path: str) -> int | None:
        """Number of the rule that decides, if any fits."""
        node, best = self.root, None
        for label in reversed(host.split(".")):
            node = node.get(("label", label))
            if node is None:
                break
            if "paths" in node:
                found = self._longest(node["paths"], path)
                best = best if found is None else found
        return best

    @staticmethod
    def _longest(node: dict, path: str) -> int | None:
        best = None
        for segment in path.split("/"):
            ends = node.get("ends")
            if ends:
                # Unfinished segments of this node that the URL's segment starts with; the longest decides.
                for size in range(len(segment), -1, -1):
                    if (hit := ends.get(segment[:size])) is not None:
                        best = hit
                        break
            node = node.get(("segment", segment))
            if node is None:
                break
        return best


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    rest = F.regexp_extract(url, r"(?s)://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """Rules as ``rule, verdict``, for :func:`judge_urls_by_join`."""
    return spark.createDataFrame([(r.text, r.verdict) for r in rules], "rule string, verdict string")


def judge_urls_by_join(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """:func:`judge_urls` for any number of ``rules(rule, verdict)``, written ``host/path``.

    Distinct URLs are judged once each, so a URL that a third of the rows share costs one; joins on a common host suffix
    or prefix are split by AQE, as the rules' side has one row per key.
    """
    written = F.col("rule").cast("string")
    at = F.instr(written, "/")
    rule_host = F.translate(F.when(at > 0, F.substring(written, F.lit(1), at - 1)).otherwise(written), _UPPER, _LOWER)
    rule_path = F.when(at > 0, F.substring(written, at, F.length(written))).otherwise("")
    verdict = F.col("verdict").cast("string")
    known = rules.where(written.isNotNull()).select(rule_host.alias("h"), rule_path.alias("p"), verdict.alias("v")).groupBy("h", "p")
    wrong = F.raise_error(F.concat("h", "p", F.lit(" is both allowed and blocked, or neither")))
    fits = (F.min("v") == F.max("v")) & (F.count("v") == F.count(F.lit(1))) & F.min("v").isin("allow", "block")
    known = known.agg(F.when(fits, F.min("v")).otherwise(wrong).alias("v"))
    known = stored(known.withColumn("n", F.length("p")))
    lengths = known.groupBy("h").agg(F.collect_set("n").alias("lengths"))
    # No rule has a host of more labels, so longer suffixes need not be asked for.
    deepest = F.lit(known.agg(F.max(F.size(F.split("h", r"\.")))).collect()[0][0] or 1)

    host, path = url_parts(F.col(f"`{url_col}`"))
    rest = [c for c in pages.columns if c.lower() not in {"host", "path", "rule", "verdict"}]
    parts = pages.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_row"), host.alias("host"), path.alias("path"))
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.greatest(F.lit(1), F.size(labels) - deepest + 1), F.size(labels)), lambda k: F.struct((F.size(labels) - k).alias("depth"), F.array_join(F.slice(labels, k, F.size(labels)), ".").alias("h")))
    asked = parts.select("host", "path").distinct().withColumn("s", F.explode(suffixes)).select("host", "path", "s.*")
    sizes = F.filter("lengths", lambda n: n <= F.length("path"))
    asked = asked.join(lengths, "h").withColumn("n", F.explode(sizes)).withColumn("p", F.expr("substring(path, 1, n)"))
    hits = asked.join(known, ["h", "p", "n"])
    best = hits.groupBy("host", "path").agg(F.max_by(F.struct(F.concat("h", "p").alias("rule"), F.col("v").alias("verdict")), F.struct("depth", "n")).alias("best"))
    judged = parts.join(best, ["host", "path"], "left")
    return judged.select("_row.*", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def judge_urls(pages: DataFrame, rules: list[Rule], url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with the columns ``host, path, rule, verdict``; those names in the input are replaced."""
    if len(rules) > MAX_RULES:
        return judge_urls_by_join(pages, rule_table(pages.sparkSession, rules), url_col, default)
    trie = UrlTrie(rules)

    @F.arrow_udf("int")
    def decide(hosts: pa.Array, paths: pa.Array) -> pa.Array:
        return pa.array([trie.find(h, p) for h, p in zip(hosts.to_pylist(), paths.to_pylist(), strict=True)], pa.int32())

    host, path = url_parts(F.col(url_col))
    number = F.col("_rule")
    names = F.array(*[F.lit(r.text) for r in trie.rules]) if trie.rules else F.array().cast("array<string>")
    verdicts = F.array(*[F.lit(r.verdict) for r in trie.rules]) if trie.rules else F.array().cast("array<string>")
    taken = {"host", "path", "rule", "verdict", "_rule"}
    rest = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in taken]
    return (
        pages.select(*rest, host.alias("host"), path.alias("path"))
        .withColumn("_rule", decide("host", "path"))
        .withColumn("rule", F.get(names, number))
        .withColumn("verdict", F.coalesce(F.get(verdicts, number), F.lit(default)))
        .drop("_rule")
    )
