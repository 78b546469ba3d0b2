"""Small tables with every awkward case: nulls, empty and long texts, repeats, clashing names."""

from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, fp long, score double, "
          "`key` string, leaf int, doc string, row string, `q.x` int")


def prose(n: int, seed: int) -> str:
    rnd = random.Random(seed)
    out = []
    while n > 0:
        k = min(n, rnd.randint(5, 12))
        out.append(" ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 7))) for _ in range(k))
                   .capitalize() + ".")
        n -= k
    return "\n".join(" ".join(out[i:i + 3]) for i in range(0, len(out), 3))


def awkward(spark, texts: list, sources: list | None = None):
    """A documents table of ``texts`` with extra columns whose names clash with internal ones."""
    rows = []
    for i, t in enumerate(texts):
        rows.append((None if t == "no id" else i, t, None if i % 5 == 0 else "en",
                     (sources[i] if sources else None if i % 7 == 3 else f"s{i % 4}"), None if t is None else len(t),
                     i, 0.5, "k", 1, None, "r", 7))
    return spark.createDataFrame(rows, SCHEMA)


def base_texts() -> list:
    a = prose(120, 1)
    return [None, "", "  \n\t", "word", "no id", a, a, a + " tail", prose(80, 2), prose(3000, 3), "x" * 5000, "ß Ä é\u3000z\u00a0w " * 3]


def rows(df) -> list:
    return sorted(map(repr, (tuple(r) for r in df.collect())))
