"""The license scan against a plain search for phrases, and its own notices."""

import random
import re

import pytest

import __spark_entry__ as spark_entry
from tallywatch.llm.license_scan import NOTICES, PHRASES, scan_licenses

from .conftest import SF, WORDS

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    starts, labels = [], set()
    for phrase, label in PHRASES.items():
        phrase = phrase.split()
        for at in range(len(words) - len(phrase) + 1):
            if words[at : at + len(phrase)] == phrase:
                starts.append(at)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def check(frame, texts):
    found = sorted(tuple(row) for row in frame.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect())
    assert found == sorted((i, *plain(t)) for i, t in texts)


def test_phrases_in_the_table(spark, sample):
    check(spark_entry.queries()["op3_license_scan"](spark, SF), sample.items())


def test_odd_texts(docs):
    texts = [
        None, "", "   ", "mit", "MIT License", "the mit license mit license", "mit-license, Mit  LICENSE!", "mit licenses",
        "general public license general public general public license", "apache license mit license gnu general public license",
        "mitİ license", "KELVIN K mit license", "mit\x00license", "license mit", "a mit license", "mit " * 3000 + "license",
        "1 2 3 mit license 4", "mit license", "mit license",
    ]
    check(scan_licenses(docs(texts)), enumerate(texts))
    repeated = [(5, "mit license"), (5, "apache license x"), (None, "mit license"), (None, "")]
    found = scan_licenses(docs(repeated)).select("doc_id", "n_words", "labels").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(
        map(str, [(5, 2, "mit"), (5, 3, "apache"), (None, 2, "mit"), (None, 0, "")])
    )
    assert scan_licenses(docs(["x"]).where("false")).count() == 0


def test_notices_are_found_with_words_changed(docs):
    draw = random.Random(4)
    texts, expected = [], []
    for notice, label in NOTICES:
        words = notice.split()
        filler = draw.choices(WORDS, k=30)
        texts.append(" ".join(filler + words + filler))
        expected.append(label)
        if len(words) >= 20:
            changed = words[:8] + ["put", "in"] + words[8:12] + words[13:]
            texts.append(" ".join(filler + changed + filler))
            expected.append(label)
            texts.append(" ".join(filler + draw.sample(words, len(words)) + filler))
            expected.append(None)
    rows = scan_licenses(docs(texts)).orderBy("doc_id").collect()
    for row, label in zip(rows, expected):
        if label:
            assert label in row.labels.split(",") and row.score >= 0.6
        else:
            assert row.labels in ("", "bsd") and row.score < 1


def plain_labels(text, coverage=0.6, shift=3, short=12):
    """Labels and score by trying every template at every place."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    labels, best, phrase_met = set(), 0.0, False
    for number, (template, label) in enumerate([*PHRASES.items(), *NOTICES]):
        template = template.split()
        pairs = list(zip(template, template[1:]))
        votes = {}
        for place, pair in enumerate(zip(words, words[1:])):
            for at, wanted in enumerate(pairs):
                if pair == wanted:
                    votes.setdefault(place - at, set()).add(at)
        spans, before = [], None
        for diagonal in sorted(votes):
            if before is None or diagonal - before > (0 if len(pairs) < short else shift):
                spans.append(set())
            spans[-1] |= votes[diagonal]
            before = diagonal
        share = max((len(span) / len(pairs) for span in spans), default=0.0)
        if share == 1 or (len(pairs) >= short and share >= coverage):
            labels.add(label)
        best, phrase_met = max(best, share), phrase_met or (share == 1 and number < len(PHRASES))
    return ",".join(sorted(labels)), 1.0 if phrase_met else best


def test_labels_and_score_equal_plain_code(docs):
    draw = random.Random(9)
    vocabulary = sorted({word for notice, _ in NOTICES for word in notice.split()}) + WORDS
    texts = []
    for _ in range(150):
        words = draw.choices(vocabulary, k=draw.randint(0, 30))
        for _ in range(draw.randint(0, 3)):
            notice = draw.choice([*PHRASES, *(text for text, _ in NOTICES)]).split()
            notice = [word for word in notice if draw.random() > draw.choice([0, 0.05, 0.3])]
            at = draw.randint(0, len(words))
            words[at:at] = notice
        texts.append(" ".join(words))
    rows = scan_licenses(docs(texts)).collect()
    for row in rows:
        assert (row.labels, round(row.score, 9)) == (plain_labels(texts[row.doc_id])[0], round(plain_labels(texts[row.doc_id])[1], 9))


def test_phrases_of_one_and_of_many_words(docs):
    many = " ".join(f"w{n}" for n in range(65))
    texts = ["mit", "a MIT, b mit", "x " + many + " y", "mit " * 5, many.replace("w7 ", ""), "admit", ""]
    rows = scan_licenses(docs(texts), {"mit": "mit", many: "many"}, []).orderBy("doc_id").collect()
    assert [(row.n_base, row.first_word, row.last_word, row.base_labels) for row in rows] == [
        (1, 0, 0, "mit"), (2, 1, 3, "mit"), (1, 1, 1, "many"), (5, 0, 4, "mit"), (0, None, None, ""), (0, None, None, ""), (0, None, None, "")
    ]
    assert rows[4].labels == "many"
    for phrase in (many + " w66", "", "- -"):
        with pytest.raises(ValueError):
            scan_licenses(docs(["a"]), {phrase: "p"}, [])


def test_no_python_on_the_way(spark):
    text = spark_entry.queries()["op3_license_scan"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("Python", "Pandas", "MapInArrow", "Cartesian", "NestedLoop"):
        assert unwanted not in text
