"""Small document tables with everything that may stand in a row."""

from __future__ import annotations

import random

DOCS = "doc_id bigint, text string, lang string, kept string, class_id string, h string, _h string, n_chars bigint"
LONG = "verylong " * 30_000
SYLLABLES = ("ba", "ko", "rin", "tel", "um", "sha", "dro", "pli", "ne", "gor", "ist", "ua", "vem", "yl", "ost")


def words(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]


def prose(seed: int, n: int, line: int = 12) -> str:
    w = words(seed, n)
    return "\n".join(" ".join(w[i : i + line]) for i in range(0, n, line))


def table(spark, texts):
    """Documents with columns whose names clash with those of the operators."""
    rows = [(i, t, None, "kept", "class", "h", "x", None if t is None else len(t)) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


def odd_texts() -> list[tuple[int | None, str | None]]:
    """Null and empty texts, a null id, blanks, a very long text, copies, a repeated row, wide characters."""
    same = prose(1, 40)
    return [
        (5, None), (6, ""), (7, ""), (None, prose(2, 30)), (8, "   "), (9, LONG), (3, same), (4, same),
        (3, same), (10, "\n\n"), (11, "漢字 テスト 😀 ñandú\r\nÅ  ﬁ ½"), (12, "!!! ???"), (13, "a"), (14, prose(3, 500)),
    ]


def empty(spark):
    return spark.createDataFrame([], DOCS)
