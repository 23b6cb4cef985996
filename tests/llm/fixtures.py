"""Small tables with the cases every operator must stand."""

from __future__ import annotations

import random

CLASH = ["digest", "bucket", "n", "node", "key", "part", "unit", "row", "own", "_salt", "kept", "lang_pred", "score", "host", "verdict"]


def prose(seed: int, n: int, words: int = 400) -> list[str]:
    r = random.Random(seed)
    syllables = ["ta", "re", "mo", "lin", "ka", "du", "esh", "or", "vi", "pen", "sul", "gra"]
    vocabulary = ["".join(r.choices(syllables, k=r.randint(1, 4))) for _ in range(words)]
    return [" ".join(r.choices(vocabulary, k=r.randint(60, 160))) + "." for _ in range(n)]


def edge_texts() -> list[str | None]:
    a, b, *rest = prose(1, 12)
    near = a.split()
    near[10] = "changed"
    return [None, "", " ", "\n\n", "word", "two words", "12 34 !!", "  lead\ttab\u00a0blank\u2003em  trail ", "a\r\nb\x0bc\x0cd\x1ce\x85f",
            "naïve Ünïcode 漢字かな 😀 ﬁ", "x" * 3000, "ab " * 8000, a, a, a + "!", " ".join(near), b, b.upper(), *rest, b]


def documents(spark, texts=None, extra: bool = False):
    texts = edge_texts() if texts is None else texts
    langs = ["en", "de", None]
    rows = [(k, t, langs[k % 3], "src0", len(t or "")) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        from pyspark.sql import functions as F
        df = df.select("*", *[F.lit(c).alias(c) for c in CLASH])
    return df


def empty_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
