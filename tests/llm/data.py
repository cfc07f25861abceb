"""Documents that try an operator: nulls, empty and long texts, ties, repeated rows, clashing column names."""

import random

from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()), StructField("source", StringType()), StructField("n_chars", LongType())])
SYLLABLES = {"aa": ["ka", "to", "mi", "ren", "sul", "po", "da"], "bb": ["schl", "ung", "ber", "eit", "ach", "zu", "ö"], "cc": ["eau", "que", "tion", "é", "ou", "ent", "ai"]}


def words(n, seed, lang="aa"):
    rng = random.Random(seed)
    s = SYLLABLES[lang]
    return " ".join("".join(rng.choice(s) for _ in range(rng.randint(1, 4))) for _ in range(n))


def doc(i, text, lang="aa", source="s0"):
    return (i, text, lang, source, None if text is None else len(text))


def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def odd_rows():
    long = words(30_000, 99)
    return [
        doc(1, words(40, 1)),
        doc(2, None),
        doc(3, ""),
        doc(4, " \t\n\x0b\f\r "),
        doc(5, "one"),
        doc(6, "two words"),
        doc(7, long),
        doc(8, words(40, 1)),
        doc(8, words(40, 1)),
        doc(None, words(30, 5)),
        doc(9, "Ünïcödé 𝒳 <|endoftext|> a\u0301b\u00a0c\u2003d 123 !!! 'tis 's\r\n\r\n  end  "),
        doc(10, "x" * 5000, None, None),
        doc(11, words(60, 7, "bb"), "bb", "s1"),
        doc(12, words(60, 8, "cc"), "cc", ""),
    ]


def clashing(df):
    """The same rows with columns that operators might use themselves."""
    from pyspark.sql import functions as F

    for name in ("size", "rank", "off", "tile", "fp", "score", "n_tokens", "_text", "_k0", "anchor", "block", "key", "id", "v"):
        df = df.withColumn(name, F.lit("mine"))
    return df
