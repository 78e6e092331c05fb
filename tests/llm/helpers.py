"""Small tables with all the awkward rows, and what the tests compare with."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

#: Names that operators use inside; as further columns of a table they must do no harm.
CLASHING = ["row", "hash", "pos", "line", "key", "size", "digest", "block", "bucket", "chunk", "n", "id", "whole", "score", "copies", "label", "_id"]
DOCUMENT = ["doc_id", "text", "lang", "source", "n_chars"]
DOCUMENT_SQL = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rnd: random.Random, words: int) -> str:
    syllables = ["ka", "lo", "mi", "ter", "San", "ü", "dor", "é", "vin", "ra"]
    made = ["".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 4))) for _ in range(words)]
    return " ".join(w + ("\n" if i % 17 == 16 else "") for i, w in enumerate(made)).replace("\n ", "\n")


def awkward_rows(seed: int = 3, count: int = 60) -> list[tuple]:
    """Prose, exact and near copies, shared lines, missing cells, blank and very long texts, repeated rows."""
    rnd = random.Random(seed)
    shared = ["This very line is found in quite a lot of documents here.", "  Another line THAT is found in many documents, in all letter cases \t"]
    texts: list[str | None] = []
    for i in range(count):
        text = prose(rnd, rnd.randint(1, 120))
        if i % 3 == 0:
            text = shared[i % 2] + "\n" + text
        if i % 4 == 1:
            text += "\n" + (shared[1].strip().lower() if i % 8 == 1 else shared[1])
        texts.append(text)
    texts += [texts[5], texts[5], texts[7].replace(" ", "  "), texts[8] + " end", texts[9][:-1]]
    texts += [None, "", " ", "\n", "\n\n\x0b\x0c\r\n", "x", "ÄÖ", "a b", "日本語の文章", "😀" * 40, "ab" * 300, "=" * 400]
    texts.append(prose(rnd, 6000))
    rows = [(i * 3 + 1, t, "en", ["a", "b", "ä", None, "a"][i % 5], len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[2], rows[2], (rows[4][0], "another text under a known id", "en", "b", 29)]
    rows += [(None, texts[3], None, None, None), (None, None, None, None, None)]
    return rows


def documents(spark: SparkSession, rows: list[tuple], clashing: bool = True) -> DataFrame:
    df = spark.createDataFrame(rows, DOCUMENT_SQL)
    for name in CLASHING if clashing else []:
        df = df.selectExpr("*", f"'{name}' AS `{name}`")
    return df.repartition(3)
