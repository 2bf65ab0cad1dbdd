from __future__ import annotations

import numpy as np
import pytest

PROSE = {
    "en": "the quick brown fox jumps over the lazy dog while seven wizards make toxic brew for the evil queen and jack near that old river".split(),
    "de": "zwölf boxkämpfer jagen viktor quer über den großen sylter deich während die heiße sonne auf das grüne feld und den wald scheint".split(),
    "fr": "portez ce vieux whisky au juge blond qui fume sur son île intérieure à côté des hôtels près de la forêt où il pleut".split(),
}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, count: int, lang: str = "en") -> str:
    random = np.random.default_rng(seed)
    return " ".join(random.choice(PROSE[lang], count))


def rows() -> list[tuple]:
    """Documents with every awkward case: nulls, blanks, copies, near copies, repeats, a long text."""
    out = []
    for k in range(90):
        lang = ("en", "de", "fr")[k % 3]
        text = "\n".join(prose(1000 * k + j, 25, lang) for j in range(4))
        out.append((k, text, lang, f"s{k % 4}" if k % 9 else None, len(text)))
    shared = prose(7, 60)
    for k in range(90, 96):
        text = f"{prose(k, 12)}\n{shared}\n{prose(k + 50, 12)}"
        out.append((k, text, "en", "s0", len(text)))
    base = prose(99, 120).split()
    for k in range(96, 102):
        words = [*base]
        words[20 * (k - 96)] = "changed"
        out.append((k, " ".join(words), "en", "s1", 0))
    out += [(k, out[3][1], "en", "s2", 0) for k in (102, 103, 104)]
    out += [
        (105, None, None, None, None),
        (106, "", "en", "s1", 0),
        (107, " \n\t ", "en", "s1", 4),
        (108, "12 34 !!", None, "s9", 8),
        (109, "é", "fr", "s9", 1),
        (110, "one two", "en", "s1", 7),
        (None, prose(1, 80), "en", "s3", 0),
        (None, prose(1, 80), "en", "s3", 0),
        (111, out[5][1], "en", "s3", 0),
        (111, out[5][1], "en", "s3", 0),
        (112, prose(5, 30_000), "en", "s3", 0),
        (113, "a" * 50_000, "en", "s3", 50_000),
        (114, out[0][1].replace(" ", "  ", 1), "en", "s3", 0),
    ]
    return out


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3, "doc_id")


@pytest.fixture(scope="session")
def clashing(awkward):
    """The same rows with further columns that carry the operators' inner names."""
    from pyspark.sql import functions as F

    names = ("rid", "doc", "size", "copies", "key", "node", "root", "words", "bin", "spans", "held", "marks", "sieve_bit", "w", "v", "score", "target")
    return awkward.withColumns({name: F.lit("extra") for name in names})


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
