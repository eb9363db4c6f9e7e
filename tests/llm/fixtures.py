"""Small awkward tables for the corpus operators."""

from __future__ import annotations

import random

DOCS = ("doc_id long, text string, lang string, score string, row string, label string, "
        "key string, block string, words string, items string")
OTHER = ("x",) * 8


def docs_frame(spark, rows, schema=DOCS):
    """``(doc_id, text)`` rows with columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, *OTHER) for r in rows], schema)


def prose(seed: int, words: int) -> str:
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdeéñ ,.") if rnd.random() < .1 else
                            rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8)))
                    for _ in range(words))


def awkward_rows() -> list[tuple]:
    """Nulls, empty texts, a very long one, exact and near copies, repeated rows and no id."""
    base = prose(1, 80)
    near = base.split(" ")
    near[40] = "changed"
    return [(1, base), (2, base), (3, " ".join(near)), (4, ""), (5, None), (6, " \t\n"),
            (7, "one"), (7, "one"), (8, prose(2, 6000)), (9, base.upper()),
            (10, "ü" * 300), (11, "a" * 500), (12, "x y"), (13, prose(3, 40) + base),
            (14, prose(4, 30)), (14, prose(5, 30)), (15, "one<|endoftext|>two <|endoftext|> three"),
            (None, base), (None, None)]
