import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, g int, text_ string, bucket string"


def words(rng, n, vocabulary=200):
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


def odd_rows():
    """Copies, near copies, shared passages, null and empty texts and ids, repeated rows."""
    rng = random.Random(5)
    base = [words(rng, n) for n in (3, 5, 60, 120, 300)]
    passage = words(rng, 55)
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(10 + i, t) for i, t in enumerate(base)]  # exact copies
    near = base[4].split(" ")
    for i in range(12):  # a group of near copies
        w = list(near)
        w[20 * i + 3] = f"new{i}"
        rows.append((30 + i, " ".join(w)))
    for i in range(6):  # a common passage, at different places
        rows.append((50 + i, words(rng, 40 * i) + "  " + passage + "\t" + words(rng, 70)))
    rows += [(70, None), (71, ""), (72, " \t\n"), (73, "One"), (74, "one"), (None, base[3]), (None, None),
             (3, base[3]), (3, base[2]), (80, "a " * 400), (81, "a " * 400 + "b"),
             (82, "é" * 200 + " ß" * 60), (83, "é" * 200 + " ß" * 61)]
    lines = [words(rng, n) for n in (2, 3, 25, 4, 6)]
    rows += [(90, "\n".join(lines)), (91, "\n".join(["x y", *lines[1:3], "", "z"])),
             (92, "\n".join([lines[0], "q", lines[2], "q"])), (93, "\n".join([lines[0], lines[1], "", lines[3]])),
             (94, "\n\n\n"), (95, "k l\nm n\nk l\nm n\nk l")]
    return rows


@pytest.fixture(scope="session")
def odd():
    return odd_rows()


@pytest.fixture(scope="session")
def frame(spark):
    def make(rows, parts=3):
        full = [(i, t, "en" if (i or 0) % 2 else None, None if (i or 1) % 7 == 0 else f"s{(i or 0) % 3}",
                 None if t is None else len(t), 7, "other", "bucket") for i, t in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)
    return make
