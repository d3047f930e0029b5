"""Small tables with the cases every operator must stand: nulls, empty and long texts, repeats, ties."""

from __future__ import annotations

import random

SYLLABLES = "ka lo mi tu re sa no vi pe du ra ze fo gi".split()


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(words))


def edited(rng: random.Random, text: str, words: int) -> str:
    out = text.split(" ")
    for _ in range(words):
        out[rng.randrange(len(out))] = "x" + str(rng.randrange(10**6))
    return " ".join(out)


def documents(seed: int = 1, plain: int = 60) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars)."""
    rng = random.Random(seed)
    texts: list[str | None] = [prose(rng, rng.randint(1, 120)) for _ in range(plain)]
    base = prose(rng, 90)
    texts += [base] * 12 + [edited(rng, base, k) for k in (1, 1, 2, 2, 3, 5, 8, 20)]
    shared = prose(rng, 60)
    texts += [prose(rng, 40) + " " + shared + " " + prose(rng, 40) for _ in range(10)]
    texts += [None, "", " \n\t ", "one", "two words", "two words", "Two WORDS", "a b c d e", prose(rng, 6000)]
    rows = []
    for i, t in enumerate(texts):
        source = None if i % 17 == 0 else "hot" if i % 3 == 0 else f"s{i % 4}"
        rows.append((i * 3 + 1, t, ["xx", "yy", None][i % 3], source, None if t is None else len(t)))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema=SCHEMA, parts=3):
    return spark.createDataFrame(rows, schema).repartition(parts)
