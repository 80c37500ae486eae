import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label int, node string, size int"
SYLLABLES = {
    "en": "the and ing ion ent her tha ere ate ver wor lik".split(),
    "de": "der und sch ein ung lic ach ten ber auf wör keit".split(),
    "fr": "les que ment tion dans pour eau oui ère ais eux une".split(),
}


def words(rng, lang, n):
    return ["".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(n)]


def prose(rng, lang, n, line=12):
    own = words(rng, lang, n)
    return "\n".join(" ".join(own[i : i + line]) for i in range(0, n, line))


def near(rng, text, changes, lang="en"):
    own = text.split(" ")
    for _ in range(changes):
        own[rng.randrange(len(own))] = words(rng, lang, 1)[0] + "x"
    return " ".join(own)


@pytest.fixture(scope="session")
def corpus(spark):
    """Documents of three languages with families of copies, and all that is odd: nulls, empty texts, repeats, clashing columns."""
    rng = random.Random(5)
    rows = []
    for i in range(90):
        lang = ("en", "de", "fr")[i % 3]
        rows.append([i, prose(rng, lang, rng.randint(5, 120)), lang, f"s{i % 4}"])
    base = prose(rng, "en", 150)
    rows += [[100 + i, base, "en", "s0"] for i in range(8)]
    rows += [[120 + i, near(rng, base, 3), "en", "s0"] for i in range(12)]
    rows += [[140 + i, near(rng, base, 8), "en", "s1"] for i in range(6)]
    rows += [
        [200, None, "en", "s1"],
        [201, "", "en", None],
        [202, " \n\t ", None, "s1"],
        [203, "one two", "en", "s9"],
        [204, "One TWO", "en", "s9"],
        [205, "12 34 !!", None, "s2"],
        [206, prose(rng, "de", 6000), "de", "s2"],
        [207, "a" * 5000, None, None],
        [208, "İstanbul K café \U0001f600 é", "en", "s3"],
        [None, base, "en", "s0"],
        [None, None, None, None],
    ]
    rows += [list(rows[3]), list(rows[3])]
    return spark.createDataFrame([(*row, None if row[1] is None else len(row[1]), 1, "x", 7) for row in rows], SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def rows_of(corpus):
    return corpus.collect()
