import random

import pytest

#: Names that operators use inside or return; an input may have them too.
CLASHING = (
    "size", "place", "row", "words", "lines", "n_words", "key", "kept", "node", "copies",
    "doc", "start", "shard", "lang_pred", "judged", "risk", "host", "target", "of", "tag",
)
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng, n, stem="ab"):
    return " ".join(rng.choice(stem) + str(rng.randrange(400)) for _ in range(n))


@pytest.fixture(scope="session")
def rng():
    return random.Random(5)


@pytest.fixture(scope="session")
def documents(spark):
    """A frame of documents from (doc_id, text, lang, source), with columns whose names clash."""

    def make(rows):
        full = [(*row, *[None] * (4 - len(row))) for row in rows]
        values = [(*row, len(row[1] or ""), *map(str, range(len(CLASHING)))) for row in full]
        schema = ", ".join([COLUMNS, *[f"{name} string" for name in CLASHING]])
        return spark.createDataFrame(values, schema)

    return make


@pytest.fixture(scope="session")
def tricky(documents):
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    rng = random.Random(7)
    base = sentence(rng, 300)
    rows = [
        (1, None, None, None),
        (None, "a text without an id, twice", "en", "s1"),
        (None, "a text without an id, twice", "en", "s1"),
        (None, None, None, None),
        (2, "", "en", "s1"),
        (3, " \t\n\x0b\x0c\r ", "en", "s2"),
        (4, base, "en", "s2"),
        (4, base, "en", "s2"),
        (4, sentence(rng, 40), "de", "s3"),
        (5, base.upper(), None, "s1"),
        (6, "Ünï çødé — 漢字 🙂 ퟿ " + base, "de", None),
        (7, sentence(rng, 30_000), "en", "s1"),
        (8, "word", "en", ""),
        (9, "two words", "en", "s3"),
        (10, "# * $ % & | < >", "xx", "s3"),
        (-11, "line one is long enough\nLINE ONE IS LONG ENOUGH \n\nlast", "en", "s3"),
        (12, "line one is long enough\nshort", "en", "s3"),
        (13, "\x1cseparated\x1dby\x01marks\x00", "en", "s3"),
        (14, "<|endoftext|> <|ENDOFTEXT|> don't, stop. ÉCOLE.", "fr", "s2"),
    ]
    rows += [(20 + n, f"{base} {sentence(rng, 2)}", "en", "s1") for n in range(6)]
    rows += [(30 + n, sentence(rng, 80, "cd"), "de", "s2") for n in range(8)]
    return documents(rows)


@pytest.fixture(scope="session")
def nothing(documents):
    return documents([])
