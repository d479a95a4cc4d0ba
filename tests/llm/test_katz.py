"""Language-model scores against a plain model of the same definition."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__ as spark_entry
from tallywatch.llm import katz
from tallywatch.llm.katz import LARGEST, discounts, language_scores, packed, unpacked

from .conftest import SF

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Plain:
    def __init__(self, texts, order=2):
        self.order = order
        self.tokens = {i: [w for w in split(t) if w] + ["</s>"] for i, t in texts.items()}
        train = [t for i, t in self.tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2]
        self.c = [Counter() for _ in range(order)]
        for t in train:
            for h, w in self.runs(t):
                for level in range(min(len(h), order - 1) + 1):
                    self.c[level][(*h[len(h) - level :], w)] += 1
        self.n = sum(self.c[0].values())
        self.d = [discounts(np.array([Counter(x.values())[r] for r in range(1, LARGEST + 2)], float)) for x in self.c]
        self.p0 = {run: self.left(0, n) / self.n for run, n in self.c[0].items()}
        self.unseen = 1 - sum(self.p0.values()) if self.n else 1.0
        kept, shares = defaultdict(float), defaultdict(float)
        for level in range(1, order):
            for run, n in self.c[level].items():
                kept[run[:-1]] += self.left(level, n) / self.c[level - 1][run[:-1]]
                shares[run[:-1]] += self.p(run[1:-1], run[-1])
        self.weight = {h: (1 - kept[h]) / (1 - shares[h]) for h in kept}

    def runs(self, t):
        """Each token with its context, which begins with the end token at the earliest."""
        for at, w in enumerate(t):
            yield (["</s>"] + t[:at])[-(self.order - 1) :], w

    def left(self, level, n):
        return n * self.d[level][n] if n <= LARGEST else n - 0.5

    def p(self, h, w):
        h = tuple(h)
        if not h:
            return self.p0.get((w,), self.unseen)
        if n := self.c[len(h)][(*h, w)]:
            return self.left(len(h), n) / self.c[len(h) - 1][h]
        return self.weight.get(h, 1.0) * self.p(h[1:], w)

    def row(self, i):
        t = self.tokens[i]
        base = sum(math.log10((self.c[0][(w,)] + 1) / (self.n + len(self.c[0]) + 1)) for w in t)
        score = sum(math.log10(self.p(h, w)) for h, w in self.runs(t))
        held = zlib.crc32(str(i).encode()) % 7 == 2
        return (i, held, len(t), sum(self.c[0][(w,)] > 0 for w in t), self.n), base, score


def split(text):
    for space in "\t\n\v\f\r":
        text = (text or "").replace(space, " ")
    return text.translate(LOWER).split(" ")


def check(rows, texts, order=2):
    plain = Plain(texts, order)
    assert len(rows) == len(texts)
    for row in rows:
        whole, base, score = plain.row(row.doc_id)
        assert tuple(row)[:5] == whole
        assert row.base_score == pytest.approx(base, rel=1e-9, abs=1e-9)
        assert row.score == pytest.approx(score, rel=1e-8, abs=1e-9)
    return plain


def test_scores_of_the_table(spark, sample):
    plain = check(spark_entry.queries()["op6_katz"](spark, SF).collect(), sample)
    sums_to_one(plain, [("</s>",), ("the",), ("never met",), *list(plain.c[0])[:20]])


def sums_to_one(plain, contexts):
    words = [w for (w,) in plain.c[0]]
    for context in contexts:
        assert sum(plain.p(context, w) for w in words) + plain.p(context, "never") == pytest.approx(1)


@pytest.mark.parametrize("order", [3, 4])
def test_other_orders(docs, table, sample, order):
    texts = dict(list(sample.items())[:50])
    plain = check(language_scores(table(docs(list(texts.items()))), order=order).collect(), texts, order)
    sums_to_one(plain, [("never", "met"), ("the", "the"), *(run for run in list(plain.c[1])[:20] if run[-1] != "</s>")])
    with pytest.raises(ValueError):
        language_scores(docs(["a"]), order=1)


def test_small_chunks_give_the_same(spark, docs, table, sample, monkeypatch):
    """Every pair is owned once, however the texts are cut; workers see the
    limit through the function's default."""
    monkeypatch.setattr(katz.chunks, "__defaults__", (300,))
    texts = dict(list(sample.items())[:60])
    check(language_scores(table(docs(list(texts.items())))).collect(), texts)


def test_odd_texts(spark, docs, table):
    texts = dict(enumerate([None, "", " ", "A a", "a", "a b", "x" * 5000, "a b " * 20_000, "é É", "\x00 a", "a", "a a a"]))
    check(language_scores(table(docs(list(texts.items())))).collect(), texts)
    twice = language_scores(table(docs([(3, "a b"), (3, "a b"), (None, "a"), (None, "c")]))).collect()
    assert len(twice) == 4 and all(math.isfinite(row.score) for row in twice)


def test_nothing_to_learn_from(spark, docs, table):
    assert language_scores(table(docs(["a"]).where("false"))).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    (row,) = language_scores(table(docs([(held, "a b")]))).collect()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (True, 3, 0, 0)
    assert (row.base_score, row.score) == (0, 0)


def test_discounts():
    usual = discounts(np.array([1000, 300, 150, 90, 60, 45.0]))
    assert (usual[1:] > 0).all() and (usual[1:] < 1).all() and usual[1] == pytest.approx((0.6 - 0.27) / 0.73)
    assert discounts(np.zeros(6))[1:].tolist() == (1 - 0.5 / np.arange(1, 6)).tolist()
    assert ((0 < discounts(np.array([5, 0, 9, 1, 0, 2.0]))[1:]) & (discounts(np.array([5, 0, 9, 1, 0, 2.0]))[1:] < 1)).all()


def test_byte_planes():
    values = np.array([0, 1, 2**40, 2**64 - 1], "<u8")
    assert unpacked(packed(values), "<u8").tolist() == values.tolist()
    assert len(unpacked(packed(values[:0]), "<u8")) == 0
