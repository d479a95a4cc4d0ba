import math
import re
from collections import Counter

import pytest

from tallywatch.llm.lexical_search import ranked_documents, terms_of

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def plain_terms(text):
    small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(TERM, small)


def plain_ranking(docs, items, k=20):
    counts = [(doc_id, Counter(plain_terms(text))) for doc_id, text in docs]
    sizes = [sum(terms.values()) for _, terms in counts]
    n, total = sum(size > 0 for size in sizes), sum(sizes)
    df = Counter(term for _, terms in counts for term in terms)
    out = []
    for item_id, text in items:
        scores = []
        for (doc_id, held), size in zip(counts, sizes):
            score = 0
            for term in plain_terms(text):
                if tf := held[term]:
                    m = 75 + 25 * size * n // total
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                    score += w * (10**9 * tf // (1000 * tf + 12 * m))
            if score > 0 and doc_id is not None:
                scores.append((-score, doc_id))
        out += [(item_id, rank, doc_id, -score) for rank, (score, doc_id) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame(
        [(item_id, text, 1, "x") for item_id, text in rows], "item_id long, text string, size long, term string"
    )


def found(rows):
    return sorted(map(tuple, rows.select("item_id", "rank", "doc_id", "score").collect()))


def test_terms():
    text = "A-Za z09_Ünï\x00İ`{|}~[\\]^@/:Ab\u2028c\x85d\x1fe"
    assert [term.decode() for term in terms_of(text)] == plain_terms(text)


def test_edge_cases(docs, items, table):
    texts = [None, "", "...", "one two two", "One, TWO two!", "three", "one " * 5000, "four one two three", "İstanbul one"]
    given = [*enumerate(texts), (None, "one one"), (40, "two three"), (40, "two three"), (41, "three " * 300_000)]
    asked = [(1, "one two TWO"), (2, ""), (3, None), (4, "nowhere"), (5, "three three"), (6, "İstanbul")]
    rows = ranked_documents(table(docs(given)), items([*asked, (None, "one"), (5, "three three"), (5, "x")]))
    assert rows.schema.simpleString() == "struct<item_id:bigint,rank:int,doc_id:bigint,score:bigint>"
    # Of several rows with one item id the smallest text counts.
    assert found(rows) == plain_ranking(given, asked)


def test_blocks_of_items_and_small_heaps(docs, items, sample, table):
    asked = [(number, text[:400]) for number, text in list(sample.items())[:12] if text]
    given = list(sample.items())
    rows = table(docs(given), 7)
    for k, block_bytes in ((3, 1 << 23), (20, 1000)):
        assert found(ranked_documents(rows, items(asked), k, block_bytes=block_bytes)) == plain_ranking(given, asked, k)


def test_ties_go_to_smaller_ids(docs, items, table):
    given = [(number, "same words here") for number in range(90, 0, -1)] + [(100, "other")]
    rows = found(ranked_documents(table(docs(given), 9), items([(7, "same")]), 5))
    assert [row[2] for row in rows] == [1, 2, 3, 4, 5] and len({row[3] for row in rows}) == 1


def test_empty_tables(docs, items):
    assert found(ranked_documents(docs([(1, "a")]).limit(0), items([(1, "a")]))) == []
    assert found(ranked_documents(docs([(1, "a")]), items([(1, "a")]).limit(0))) == []
