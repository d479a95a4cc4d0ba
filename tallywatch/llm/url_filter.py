"""URL filter: listed rules first, association rules for the rest.

URLs that a listed rule fits are labelled by it. The combinations of URL tokens
that are frequent among them are mined level by level; those that nearly always
come with one verdict, and say more than their parts, become rules. Each is filed
under its least common token, so that a URL meets only the rules of its own
tokens. Neither tokens nor rules are cut, and both stay in tables."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import joined_evenly, stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LISTED = "page_id long, host string, path string, tokens array<string>, rule string, verdict string"
RULES = "tokens array<string>, verdict string, confidence double, support double"


class Listed(NamedTuple):
    """A listed rule: fits its host and all subdomains, if the path starts with ``path``."""

    verdict: str
    host: str
    path: str


class Mined(NamedTuple):
    """An association rule: URLs with all these tokens get the verdict."""

    tokens: tuple[str, ...]
    verdict: str
    confidence: float
    support: float


def url_parts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, tokens``. The host stands after the first ``://`` up
    to ``/``, ``?``, ``#`` or the end, A-Z in small letters; the path goes on up to
    ``?``, ``#`` or the end. Both are empty for a null URL and one without ``://``.

    Tokens, each once: the parts of the host (also those between hyphens), of the
    path and the names in the query, marked by where they stand. Numbers name
    single pages and are no tokens."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    at = F.instr("url", "://")
    rows = rows.select("page_id", F.when(at > 0, F.substring("url", at + 3, F.length("url"))).otherwise("").alias("rest"))
    small = F.translate("rest", _UPPER, _LOWER)
    rows = rows.select(
        "page_id",
        F.regexp_extract(small, r"^[^/?#]*", 0).alias("host"),
        F.regexp_extract("rest", r"^[^/?#]*([^?#]*)", 1).alias("path"),
        F.regexp_extract(small, r"^[^/?#]*([^?#]*)", 1).alias("small_path"),
        F.regexp_extract(small, r"^[^?#]*\?([^#]*)", 1).alias("query"),
    )
    names = F.transform(F.split("query", "&"), lambda pair: F.substring_index(pair, "=", 1))
    tokens = F.concat(
        _marked("host:", F.array_union(F.split("host", r"\."), F.split("host", r"[.:\-]"))),
        _marked("path:", F.split("small_path", r"[/._\-]")),
        _marked("name:", names),
    )
    return rows.select("page_id", "host", "path", F.array_distinct(tokens).alias("tokens"))


def _marked(mark: str, parts: Column) -> Column:
    kept = F.filter(parts, lambda part: ~F.rlike(part, F.lit("^[0-9]*$")))
    return F.transform(kept, lambda part: F.concat(F.lit(mark), part))


class ListedRules:
    """Listed rules by host; of those that fit a URL the longest wins (host and
    path together, then the host)."""

    def __init__(self, rules: Sequence[Listed]):
        self.by_host: dict[str, list[Listed]] = defaultdict(list)
        for rule in rules:
            self.by_host[rule.host].append(rule)

    def fitting(self, host: str, path: str) -> Listed | None:
        best, length = None, (-1, -1)
        while True:
            for rule in self.by_host.get(host, ()):
                size = len(rule.host) + len(rule.path), len(rule.host)
                if size > length and path.startswith(rule.path):
                    best, length = rule, size
            # The labels of a host from the left on, as long as any are left.
            _, dot, host = host.partition(".")
            if not dot:
                return best


class MinedRules:
    """Inverted index of a list of mined rules, the counterpart of ``best_rules`` within
    one process: each filed under the one of its tokens that
    the fewest rules share. Of those that match, the most confident wins, then the
    one with more support, then the first by tokens."""

    def __init__(self, rules: Sequence[Mined], remembered: int = 50_000):
        common = Counter(token for rule in rules for token in rule.tokens)
        self.filed: dict[str, list[Mined]] = defaultdict(list)
        for rule in rules:
            self.filed[min(rule.tokens, key=lambda token: (common[token], token))].append(rule)
        self.known: dict[tuple[str, ...], Mined | None] = {}
        self.remembered = remembered

    def matching(self, tokens: tuple[str, ...]) -> Mined | None:
        if tokens not in self.known:
            if len(self.known) >= self.remembered:
                self.known.clear()
            held = set(tokens)
            found = (rule for token in tokens for rule in self.filed.get(token, ()) if held.issuperset(rule.tokens))
            best = min(found, key=lambda rule: (-rule.confidence, -rule.support, rule.tokens), default=None)
            if sum(map(len, tokens)) > 1000:
                return best
            self.known[tokens] = best
        return self.known[tokens]


def rule_table(
    labelled: DataFrame,
    min_support: float = 0.001,
    min_count: int = 5,
    min_confidence: float = 0.8,
    longest: int = 4,
) -> DataFrame:
    """``tokens, verdict, confidence, support`` of the rules of ``longest`` tokens at
    most, from all tokens of all labelled URLs (``tokens, verdict``), with a share of
    ``min_support`` of them and ``min_count`` at least. A rule has to be more confident
    than its verdict's share and than any rule of some of its tokens with its verdict.
    No labelled URLs give no rules.

    Sets of tokens grow by one token at a time. One whose URLs all have one verdict,
    or are just those of a part of it, is not grown: no rule on more tokens can be
    more confident. Each level is counted by shuffles over the distinct sets of
    tokens that are left of URLs."""
    urls = labelled.select(F.array_sort("tokens").alias("held"), "verdict")
    urls = _numbered(urls.groupBy("held", "verdict").agg(F.count(F.lit(1)).alias("n")))
    shares = {row["verdict"]: row["n"] for row in urls.groupBy("verdict").agg(F.sum("n").alias("n")).collect()}
    total = sum(shares.values())
    if not total:
        return labelled.sparkSession.createDataFrame([], RULES)
    least = max(min_support * total, min_count)
    held = urls.select("url", "verdict", "n", F.explode("held").alias("token"))
    held = held.select("url", "verdict", "n", F.array("token").alias("tokens"))
    share = reduce(lambda known, one: known.when(F.col("verdict") == one, shares[one] / total), shares, F)
    counts = held.groupBy("tokens", "verdict").agg(F.sum("n").alias("n"))
    nothing = counts.withColumns({"already": share, "part_of": F.lit(total)})
    level = _level(nothing, least)
    levels = [level]
    for size in range(2, longest + 1):
        grown = level.where("grows").select("tokens").distinct()
        held = held.join(grown, "tokens", "left_semi")
        if size == 2:
            # URLs that are alike in the tokens that are left count as one.
            alike = held.groupBy("url", "verdict", "n").agg(F.array_sort(F.collect_list(F.col("tokens")[0])).alias("held"))
            alike = _numbered(alike.groupBy("held", "verdict").agg(F.sum("n").alias("n")))
            held = alike.select("url", "verdict", "n", F.explode("held").alias("token"))
            held = held.select("url", "verdict", "n", F.array("token").alias("tokens"))
        ends = held.select("url", "verdict", "n", "tokens", F.slice("tokens", 1, size - 2).alias("begin"))
        more = ends.select("url", "begin", F.element_at("tokens", -1).alias("further"))
        pairs = ends.join(more, ["url", "begin"]).where(F.element_at("tokens", -1) < F.col("further"))
        held = stored(
            pairs.select("url", "verdict", "n", F.concat("tokens", F.array("further")).alias("tokens")), "url-held"
        )
        counts = stored(held.groupBy("tokens", "verdict").agg(F.sum("n").alias("n")), "url-counts")
        counts = counts.join(_parts_best(counts, level, size), ["tokens", "verdict"])
        level = _level(counts, least)
        if level.isEmpty():
            break
        levels.append(level)
    rules = reduce(DataFrame.unionByName, levels)
    kept = (F.col("n") >= least) & (F.col("confidence") >= min_confidence) & (F.col("confidence") > F.col("already"))
    return rules.where(kept).select("tokens", "verdict", "confidence", (F.col("n") / total).alias("support"))


def _numbered(urls: DataFrame) -> DataFrame:
    return stored(urls.withColumn("url", F.monotonically_increasing_id()), "url-baskets")


def _level(counts: DataFrame, least: float) -> DataFrame:
    """Sets of one size by verdict, those that are frequent with some verdict, and
    whether they can grow. ``already`` is the best confidence of a part with the
    verdict, ``part_of`` the least number of URLs of a part."""
    of = Window.partitionBy("tokens")
    whole = counts.withColumns({"of": F.sum("n").over(of), "most": F.max("n").over(of)})
    frequent = whole.where(F.col("most") >= least).withColumn("confidence", F.col("n") / F.col("of"))
    grows = (F.col("most") < F.col("of")) & (F.col("of") < F.col("part_of"))
    return stored(frequent.withColumn("grows", grows).drop("part_of", "most"), "url-level")


def _parts_best(counts: DataFrame, level: DataFrame, size: int) -> DataFrame:
    """``tokens, verdict, already, part_of`` of the sets whose parts of one token
    less can all grow. A verdict that a part never has counts as no confidence."""
    without = F.transform(
        F.sequence(F.lit(1), F.lit(size)),
        lambda place: F.filter("tokens", lambda token, at: at != place - 1),
    )
    parts = counts.select("tokens", "verdict", F.explode(without).alias("part"))
    known = level.where("grows").select(
        F.col("tokens").alias("part"), "verdict", F.greatest("already", "confidence").alias("best"), "of"
    )
    return (
        parts.join(known, ["part", "verdict"])
        .groupBy("tokens", "verdict")
        .agg(F.max("best").alias("already"), F.min("of").alias("part_of"), F.count(F.lit(1)).alias("parts"))
        .where(F.col("parts") == size)
        .drop("parts")
    )


def mined_rules(labelled: DataFrame, **mining: float) -> list[Mined]:
    """The rules of ``rule_table`` as a list, best first, for those who look at them."""
    rows = rule_table(labelled, **mining).orderBy(F.desc("confidence"), F.desc("support"), "tokens", "verdict")
    return [Mined(tuple(row.tokens), row.verdict, row.confidence, row.support) for row in rows.collect()]


def best_rules(shapes: DataFrame, rules: DataFrame) -> DataFrame:
    """For each row of ``shapes`` (distinct ``tokens``, ``members``) that some rule
    matches the best one, ordered as in ``MinedRules``: ``tokens, members, mined_rule,
    mined_verdict, confidence``. Each rule is filed under the one of its tokens that
    the fewest rules share, and rows meet only the rules of their own tokens."""
    rules = stored(rules, "url-rules")
    common = rules.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("rules"))
    held = rules.select("*", F.explode("tokens").alias("token")).join(common, "token")
    order = F.struct((-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), F.col("tokens").alias("of"), "verdict")
    filed = held.groupBy("tokens", "verdict", "confidence", "support").agg(F.min(F.struct("rules", "token")).alias("least"))
    filed = filed.select(F.col("least.token").alias("token"), order.alias("rule"))
    asked = shapes.select("tokens", "members", F.explode("tokens").alias("token"))
    fits = asked.join(filed, "token").where(F.size(F.array_except("rule.of", "tokens")) == 0)
    best = fits.groupBy("tokens", "members").agg(F.min("rule").alias("rule"))
    return best.select(
        "tokens",
        "members",
        F.array_join("rule.of", " ").alias("mined_rule"),
        F.col("rule.verdict").alias("mined_verdict"),
        (-F.col("rule.c")).alias("confidence"),
    )


def judged_urls(
    pages: DataFrame,
    listed: Sequence[Listed],
    default: str = "allow",
    id_col: str = "page_id",
    url_col: str = "url",
    **mining: float,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, mined_rule, confidence`` of every page.

    The longest listed rule that fits gives the verdict; ``rule`` is its host and
    path. Other URLs get that of the best mined rule, shown in ``mined_rule``
    with its ``confidence``, or ``default`` where none matches. ``mining`` are
    limits of ``rule_table``.

    Null URLs and those without ``://`` have an empty host and path, which no rule
    fits, and get the default. Repeated rows are judged alike, and rows without an
    id are judged too; URLs of any length are taken whole; an empty table gives no
    rows; other columns are ignored."""
    parts = url_parts(pages, id_col, url_col)
    urls = stored(parts.mapInArrow(lambda batches: _listed(batches, listed), LISTED), "url-listed")
    # As the rules give the labels, the labelled URLs are those that a rule fits.
    rules = rule_table(urls.where(F.col("rule").isNotNull()), **mining)
    rest = urls.where(F.col("rule").isNull())
    found = stored(best_rules(rest.groupBy("tokens").agg(F.count(F.lit(1)).alias("members")), rules), "url-best")
    # Those that a rule fits have no shape and meet no mined rule.
    shaped = urls.withColumn("shape", F.when(F.col("rule").isNull(), F.col("tokens"))).drop("tokens")
    judged = joined_evenly(shaped, found.withColumnRenamed("tokens", "shape"), "shape", urls.count())
    verdict = F.coalesce("verdict", "mined_verdict", F.lit(default)).alias("verdict")
    return judged.select("page_id", "host", "path", "rule", verdict, "mined_rule", "confidence")


def _listed(batches: Iterator[pa.RecordBatch], listed: Sequence[Listed]) -> Iterator[pa.RecordBatch]:
    rules = ListedRules(listed)
    for batch in batches:
        fits = [rules.fitting(host, path) for host, path in _hosts_and_paths(batch)]
        rule = pa.array([rule and rule.host + rule.path for rule in fits], pa.string())
        verdict = pa.array([rule and rule.verdict for rule in fits], pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns, rule, verdict], [*batch.schema.names, "rule", "verdict"])


def _hosts_and_paths(batch: pa.RecordBatch) -> Iterator[tuple[str, str]]:
    return zip(batch["host"].to_pylist(), batch["path"].to_pylist())
