"""Small fixtures that hold the awkward cases, and brute-force helpers."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, extra=False):
    """Rows of (doc_id, text) or of all columns; ``extra`` adds columns whose names operators use inside."""
    full = [r if len(r) == 5 else (r[0], r[1], "en", "src0", None if r[1] is None else len(r[1])) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    if extra:
        from pyspark.sql import functions as F

        names = ["key", "rid", "class", "score", "rejected", "kept", "norm", "tokens", "piece", "rank", "sender", "node", "label", "row"]
        df = df.withColumns({name: F.lit(f"own {name}") for name in names})
    return df


def words(seed, n, vocabulary=4000):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def prose(seed, n, vocabulary=4000):
    return " ".join(words(seed, n, vocabulary))


def awkward():
    """Nulls, empty and white texts, repeated rows, a null id, copies, near copies and shared passages."""
    shared, long = prose(1, 60), prose(2, 400)
    near = long.split()
    near[200] = "changed"
    return [
        (5, None),
        (6, ""),
        (7, " \t\n "),
        (8, long),
        (9, " ".join(near)),
        (10, long),
        (10, long),
        (None, long),
        (11, f"{prose(3, 40)} {shared} {prose(4, 40)}"),
        (12, f"{prose(5, 30)} {shared} {prose(6, 50)}"),
        (13, "same " * 60),
        (14, "a"),
        (15, "ünï çödé ✓ 𝒳 " * 30),
        (16, prose(7, 3000)),
        (17, long.replace(" ", "\t\n ")),
        (18, f"{shared} {shared}"),
    ]


def rows_of(df, *keys):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
