"""Small tables with awkward rows."""

from __future__ import annotations

import random

CLASHES = ("size", "taken", "target", "measures", "kept", "base_failed", "contamination", "toxicity", "vpt_key",
           "kn_score", "mix_size", "host", "listed", "main_text")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          + ", ".join(f"{c} string" for c in CLASHES))


def sentence(rng: random.Random, n: int) -> str:
    parts = ["the", "and", "of", "tion", "er", "ing", "re", "st", "on", "an", "that", "ou"]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(n)).capitalize() + "."


def odd_documents(spark, n: int = 40, long_words: int = 60_000):
    """Clean texts, copies, near copies, NULLs in every column, empty and very long texts, repeated rows."""
    rng = random.Random(5)
    clean = ["\n".join(sentence(rng, 12) for _ in range(rng.randint(5, 9))) for _ in range(n)]
    rows = [(i, t, rng.choice(["en", "de"]), rng.choice(["a", "b", "c"])) for i, t in enumerate(clean)]
    rows += [(100 + i, clean[0], "en", "hot") for i in range(30)]                       # copies
    rows += [(150, clean[1] + " More.", "en", "a"), (151, clean[1], None, None)]
    rows += [(200, None, "en", "a"), (201, "", "en", "a"), (202, " \t\n\x0b ", None, "b"), (203, "Ünï x", "de", "b")]
    rows += [(None, clean[2], "en", "c"), (None, None, None, None)]
    rows += [(210, " ".join(sentence(rng, 10) for _ in range(long_words // 10)), "en", "a")]
    rows += [(211, "ab " * 5000 + "\n" + "ab ab\n" * 300, "en", "b"), (212, "### $$$ &&& " * 60, "en", "b")]
    rows += [(213, "One two three", "en", "c"), (213, "One two three", "en", "c"), (213, "Other text", "en", "c")]
    rows = [(i, t, lang, src, None if t is None else len(t), *[f"x{k}" for k in range(len(CLASHES))]) for i, t, lang, src in rows]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)
