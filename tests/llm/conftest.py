import random

import pytest

WORDS = "ash bay cot dew elm fir gap hut ivy jet kit log map net oak pin rye sea tin urn vat wax yew zip".split()


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls in every column, empty, blank and very long texts, repeated rows, and clashing columns."""
    base = prose(60, 1)
    rows = [
        (0, base), (1, base), (2, base + " tail"), (3, None), (4, ""), (5, " \t\n\r "), (6, "word"), (7, "İK É ß 漢字 \x00 word\x85word"), (8, prose(40, 2) + "\n" + prose(40, 3)),
        (9, prose(40, 3) + "\n" + prose(30, 4)), (10, "x" * 50_000), (11, prose(20_000, 5)), (12, "\n".join([prose(12, 6)] * 30)), (13, prose(40, 7)), (13, prose(40, 7)), (None, prose(40, 8)), (None, base),
        (14, "Released under the MIT License. " * 5 + "Apache license, GNU General Public License; General Public License"),
    ]
    full = [(i, t, None if k % 3 == 0 else f"s{k % 2}", None, None if k % 4 == 0 else len(t or ""), "a", 1.5, "b") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id bigint, text string, source string, lang string, n_chars bigint, fp string, kept double, lid string")


@pytest.fixture(scope="session")
def nothing(spark, awkward):
    return awkward.where("false")
