import re

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("score", "size", "kept", "piece", "n", "group", "a", "part", "lang_pred", "__x")


@pytest.fixture(scope="session")
def docs(spark):
    """Rows (doc_id, text, lang, source) as a documents table, on request with columns whose names clash."""

    def make(*rows, clash=False):
        padded = [(*r, *[None] * (4 - len(r))) for r in rows]
        table = spark.createDataFrame([(*r, len(r[1] or "")) for r in padded], DOCS).repartition(3)
        return table.withColumns({c: F.lit("x") for c in CLASH}) if clash else table

    return make


ODD = [
    (1, "Alpha beta gamma delta epsilon zeta", "en", "s1"),
    (2, "alpha BETA gamma delta epsilon zeta", "en", "s1"),
    (2, "alpha BETA gamma delta epsilon zeta", "en", "s1"),
    (3, None, None, None),
    (4, "", "de", "s2"),
    (None, "alpha beta gamma delta epsilon zeta", "en", None),
    (None, None, None, "s2"),
    (5, " \t\n ", None, "s2"),
    (6, "Ärger ärger ß 漢字 🙂 <|endoftext|> 12", "de", "s2"),
    (7, "word " * 30000, "en", "s1"),
    (8, "x" * 50000, None, "s3"),
    (9, "1234 !!! 5", "en", "s3"),
]


@pytest.fixture(scope="session")
def odd(docs):
    return docs(*ODD, clash=True)


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
