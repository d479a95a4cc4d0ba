from itertools import combinations
from random import Random

import pytest

from tallywatch.llm import queries
from tallywatch.llm.queries import URL_RULES
from tallywatch.llm.url_filter import Mined, MinedRules, best_rules, judged_urls, mined_rules, url_parts

from .conftest import SF


@pytest.fixture
def pages(spark):
    def make(urls):
        rows = [url if isinstance(url, tuple) else (number, url) for number, url in enumerate(urls)]
        full = [(i, u, "<p>", "h", "t", "v") for i, u in rows]
        return spark.createDataFrame(
            full, "page_id long, url string, html string, host string, tokens string, verdict string"
        )

    return make


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [rest.index(mark) for mark in "?#" if mark in rest]
    rest = rest[: min(ends, default=len(rest))]
    slash = rest.find("/")
    host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    fits = [
        rule
        for rule in URL_RULES
        if (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path)
    ]
    return max(fits, key=lambda rule: len(rule.host + rule.path), default=None)


URLS = [
    None,
    "",
    "no scheme.com/en/",
    "http://",
    "http://COM/",
    "http://com",
    "http://com?x=/en/",
    "http://Example.COM/en/1",
    "http://a.b.example.com/en/",
    "http://www.example.com/en/x?y#z",
    "http://m.www.example.com/en/x",
    "http://notexample.com/en/",
    "http://example.com/EN/",
    "http://example.com/en",
    "http://net/fr/#/",
    "http://xnet/fr/",
    "http://a.net/es/1://b.com/",
    "http://a.net#x/es/",
    "http://ÄÖ.İ.com/Ä",
    "http://user@host.com:80/p",
    "http://..com//x",
    "x://y.net/es/" + "long/" * 50_000,
    "://net/fr/",
    "http://a.com\n/en/",
]


def test_parts_and_listed_rules(pages, table):
    given = [*enumerate(URLS), (None, "http://com/"), (4, "http://COM/")]
    rows = judged_urls(table(pages(given)), URL_RULES).collect()
    expected = []
    for page_id, url in given:
        host, path = plain_parts(url)
        rule = plain_rule(host, path)
        expected.append((page_id, host, path, rule and rule.host + rule.path, rule and rule.verdict))
    found = [(row.page_id, row.host, row.path, row.rule, row.verdict if row.rule else None) for row in rows]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert all(row.verdict in ("allow", "block") for row in rows)
    assert {row.verdict for row in rows if row.page_id in (0, 1, 2)} == {"allow"}


def test_tokens(pages):
    row = url_parts(pages(["http://www.Free-bets.com:80/A-b/12.html/?q=1&Ref&=3#f"])).first()
    assert row.tokens == [
        *("host:www", "host:free-bets", "host:com:80", "host:free", "host:bets", "host:com"),
        *("path:a", "path:b", "path:html", "name:q", "name:ref"),
    ]


def plain_mined(labelled, min_count, min_confidence, longest):
    total = len(labelled)

    def count(tokens, verdict=None):
        return sum(set(tokens) <= held and verdict in (None, label) for held, label in labelled)

    alphabet = sorted({token for held, _ in labelled for token in held})
    confidence = {}
    for verdict in ("allow", "block"):
        for size in range(longest + 1):
            for tokens in combinations(alphabet, size):
                if (both := count(tokens, verdict)) >= min_count:
                    confidence[tokens, verdict] = both / count(tokens), both / total
    out = set()
    for (tokens, verdict), (sure, support) in confidence.items():
        parts = (part for size in range(len(tokens)) for part in combinations(tokens, size))
        if tokens and sure >= min_confidence:
            if all(confidence[part, verdict][0] < sure for part in parts):
                out.add(Mined(tokens, verdict, sure, support))
    return out


@pytest.mark.parametrize("longest", [1, 2, 4])
def test_mined_rules_equal_enumeration(spark, longest):
    rows = []
    for n in range(300):
        held = {token for token, every in (("a", 2), ("b", 3), ("c", 5), ("d", 7), ("e", 4)) if n % every == 0}
        block = {"a", "b"} <= held or ("d" in held and n % 3)
        rows.append((held, "block" if block else "allow"))
    frame = spark.createDataFrame([(sorted(held), label) for held, label in rows], "tokens array<string>, verdict string")
    found = mined_rules(frame, min_support=0.0, min_count=4, min_confidence=0.7, longest=longest)
    assert set(found) == plain_mined(rows, 4, 0.7, longest) and len(found) == len(set(found))
    assert found == sorted(found, key=lambda rule: (-rule.confidence, -rule.support, rule.tokens))


def test_matching_equals_trying_every_rule():
    rules = [
        Mined(tokens, verdict, 0.5 + len(tokens) / 10 + (ord(tokens[0]) % 2) / 100, 0.1)
        for size in (1, 2, 3)
        for tokens, verdict in zip(combinations("abcdef", size), ["allow", "block"] * 30)
    ]
    index = MinedRules(rules, remembered=10)
    for size in range(7):
        for tokens in combinations("abcdefg", size):
            fits = [rule for rule in rules if set(rule.tokens) <= set(tokens)]
            best = min(fits, key=lambda rule: (-rule.confidence, -rule.support, rule.tokens), default=None)
            assert index.matching(tokens) == best


def test_learned_verdicts_and_defaults(pages, table):
    """Blocked paths of one host are blocked elsewhere; unknown tokens get the default."""
    urls = [f"http://m{n}.net/es/casino/{n}" for n in range(30)] + [f"http://m{n}.com/news/{n}" for n in range(30)]
    new = ["http://x.org/casino/7", "http://x.org/news/7", "http://x.org/else"]
    rows = judged_urls(table(pages(urls + new)), URL_RULES, default="block").collect()
    verdicts = {row.page_id: (row.rule, row.verdict, row.mined_rule) for row in rows}
    assert verdicts[60] == (None, "block", "path:casino")
    assert verdicts[61] == (None, "allow", "path:news")
    assert verdicts[62] == (None, "block", None)


def test_empty_and_unlabelled(pages):
    assert judged_urls(pages([]), URL_RULES).collect() == []
    assert {row.verdict for row in judged_urls(pages(["http://x.org/", None]), URL_RULES).collect()} == {"allow"}


def test_query_equals_plain_rules(spark):
    urls = {row.page_id: row.url for row in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.op12_url_filter(spark, SF).collect()
    assert len(rows) == len(urls)
    for row in rows:
        rule = plain_rule(*plain_parts(urls[row.page_id]))
        assert (row.host, row.path) == plain_parts(urls[row.page_id])
        assert row.rule == (rule and rule.host + rule.path) and (not rule or row.verdict == rule.verdict)


def test_late_tokens_and_long_urls_are_mined(spark):
    """A token that decides stands behind thirty others, which no cap may hide; a URL of
    forty tokens that come together has no more sets than it needs."""
    before = [f"path:{n:02}" for n in range(30)]
    rows = [(before + ["path:casino"], "block")] * 10 + [(before + ["path:news"], "allow")] * 10
    rows += [([f"name:{n:02}" for n in range(40)], "allow")] * 10 + [([], "block")] * 3
    found = mined_rules(spark.createDataFrame(rows, "tokens array<string>, verdict string"))
    expected = {("path:casino",): "block", ("path:news",): "allow", **{(f"name:{n:02}",): "allow" for n in range(40)}}
    assert {rule.tokens: rule.verdict for rule in found} == expected


def test_no_rule_is_left_out(spark):
    """More rules than any cap on their number kept."""
    rows = [([f"path:{n}"], "block" if n % 2 else "allow") for n in range(20_500)]
    found = mined_rules(spark.createDataFrame(rows, "tokens array<string>, verdict string"), min_support=0.0, min_count=1)
    assert len(found) == 20_500


@pytest.mark.parametrize("seed", range(3))
def test_mined_sets_equal_enumeration_on_random_urls(spark, seed):
    draw = Random(seed)
    rows = []
    for _ in range(60):
        held = {token for token in "abcdefg" if draw.random() < 0.5}
        rows.append((held, "block" if len(held & set("abc")) >= draw.choice([1, 2, 2, 3]) else "allow"))
    frame = spark.createDataFrame([(sorted(held), label) for held, label in rows], "tokens array<string>, verdict string")
    found = mined_rules(frame, min_support=0.0, min_count=2, min_confidence=0.5, longest=4)
    assert set(found) == plain_mined(rows, 2, 0.5, 4) and len(found) == len(set(found))


def test_joined_rules_equal_the_index(spark):
    rules = [
        Mined(tokens, verdict, 0.5 + len(tokens) / 10 + (ord(tokens[0]) % 2) / 100, 0.1)
        for size in (1, 2, 3)
        for tokens, verdict in zip(combinations("abcdef", size), ["allow", "block"] * 30)
    ][3:]
    shapes = [tokens for size in range(7) for tokens in combinations("gfedcba", size)]
    frame = spark.createDataFrame([(list(tokens), 1) for tokens in shapes], "tokens array<string>, members long")
    table = spark.createDataFrame(
        [(list(rule.tokens), *rule[1:]) for rule in rules], "tokens array<string>, verdict string, confidence double, support double"
    )
    found = {tuple(row.tokens): (row.mined_rule, row.mined_verdict, row.confidence) for row in best_rules(frame, table).collect()}
    index = MinedRules(rules)
    best = {tokens: index.matching(tokens) for tokens in shapes}
    assert found == {tokens: (" ".join(rule.tokens), *rule[1:3]) for tokens, rule in best.items() if rule}
