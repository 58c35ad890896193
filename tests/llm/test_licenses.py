import re
from collections import Counter

import pytest

from browsekit.llm import licenses

from .cases import SCHEMA, clashing, empty_docs, odd_docs, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(text):
    words = WORD.findall((text or "").translate(LOWER))
    places, labels = [], set()
    for phrase, label in licenses.BASE_PHRASES.items():
        p = phrase.split()
        for i in range(len(words)):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


COLS = ("n_words", "n_base", "first_word", "last_word", "base_labels")


def check(docs):
    rows = licenses.scan_licenses(docs).collect()
    assert Counter((r["doc_id"], *(r[c] for c in COLS)) for r in rows) == Counter(
        (r["doc_id"], *brute(r["text"])) for r in docs.select("doc_id", "text").collect())
    for r in rows:
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"])
    return rows


def texts(spark, *rows):
    return spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(rows)], SCHEMA)


def test_odd_rows_and_clashing_names(spark):
    check(odd_docs(spark))
    check(clashing(odd_docs(spark)))
    assert check(empty_docs(spark)) == []


def test_whole_table(spark):
    rows = check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert any(r["n_base"] for r in rows) and any("gpl-3" in r["labels"] for r in rows)


def test_phrases_at_edges_and_side_by_side(spark):
    rows = check(texts(
        spark, "Under the MIT License", "CC-BY-NC cc by nc/CC BY NC", "cc by ncx xcc by nc", "ünder the mit license",
        prose(1, 5000) + " Apache License, Version 2.0", "under the\nmit--license under THE mit license.", "cc\0by\x7fnc"))
    assert [r["n_base"] for r in rows] == [1, 3, 0, 0, 1, 2, 1]


@pytest.mark.parametrize("text,postfix", [
    ("MIT", ["mit"]), ("MIT OR Apache-2.0", ["mit", "apache-2.0", "or"]),
    ("MIT AND (GPL-2.0-only OR BSD-3-Clause) */", ["mit", "gpl-2.0-only", "bsd-3-clause", "or", "and"]),
    ("GPL-2.0-or-later WITH Classpath-exception-2.0 OR MIT AND ISC",
     ["gpl-2.0-or-later", "classpath-exception-2.0", "with", "mit", "isc", "and", "or"]),
    ("", []), (")", []), ("AND MIT", []), ("MIT OR", ["mit"]), ("(MIT", ["mit"]), ("MIT)", ["mit"]), ("MIT Apache-2.0", ["mit"]),
])
def test_shunting_yard(text, postfix):
    assert licenses.parse_expression(text) == postfix


def test_evaluation():
    def level(text):
        return licenses.evaluate(licenses.parse_expression(text))[1]

    assert level("MIT OR GPL-3.0-only") == 1 and level("MIT AND GPL-3.0-only") == 3
    assert level("GPL-2.0-only WITH Classpath-exception-2.0") == 2
    assert level("CC0-1.0 AND (MPL-2.0 OR MIT)") == 1 and level("no-such-license") == 4
    assert licenses.evaluate(licenses.parse_expression("Apache-2.0 OR MIT"))[0] == {"apache-2", "mit"}


def test_tags(spark):
    rows = licenses.scan_licenses(texts(
        spark, "// SPDX-License-Identifier: (MIT OR Apache-2.0)\ncode", "# spdx-license-identifier: GPL-3.0-only", "SPDX license",
        "SPDX-License-Identifier:")).collect()
    assert [r["labels"] for r in rows] == ["apache-2,mit", "gpl-3", "", ""]
    assert [r["level"] for r in rows] == [1, 3, None, None]


def scanned(spark, *texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return sorted(licenses.scan_licenses(docs).collect(), key=lambda r: r["doc_id"])


def test_or_later_forms_and_slashes(spark):
    tag = "SPDX-License-Identifier: "
    rows = scanned(spark, tag + "GPL-2.0+", tag + "LGPL-2.1+", tag + "Apache-2.0+", tag + "MIT/Apache-2.0", tag + "MIT / later")
    assert [(r["labels"], r["level"]) for r in rows] == [("gpl-2", 3), ("lgpl", 2), ("apache-2", 1), ("apache-2,mit", 1), ("mit", 1)]


def test_the_longest_phrase_speaks(spark):
    rows = scanned(spark, "GNU General Public License version 3", "GNU General Public License", "under the MIT license",
                   "the MIT license", "GNU General Public License version 3, GNU General Public License")
    assert [r["labels"] for r in rows] == ["gpl-3", "gpl", "mit", "mit", "gpl,gpl-3"]
    assert abs(rows[2]["score"] - licenses.BASE_TRUST) < 1e-9 and abs(rows[3]["score"] - licenses.NOTICE_TRUST) < 1e-9


def test_word_numbers_take_linear_time(spark):
    import time

    text = "cc by nc text " * 360_000      # 5 MB
    began = time.monotonic()
    row = scanned(spark, text)[0]
    assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"]) == (1_440_000, 360_000, 0, 1_439_996)
    assert time.monotonic() - began < 30
