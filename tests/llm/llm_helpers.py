"""Small document tables for the operator tests."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, row string, host string"


def words(rng: random.Random, n: int, letters: str = "abcdefghij") -> list[str]:
    return ["".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n)]


def docs(spark, rows, lang="en", source="s0"):
    """Documents from (doc_id, text) or (doc_id, text, source), with extra columns whose names may clash."""
    full = [(r[0], r[1], lang, r[2] if len(r) > 2 else source, len(r[1] or ""), 0.5, "x", "h") for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_texts() -> list[str | None]:
    return [None, "", " ", "\n\n", "a", "a  b", " lead", "trail ", "x\n\ny", "it's o'clock", "日本語 テスト", "é ́x",
            "<|endoftext|> hi", "foo\r\nbar\t baz", "naïve café ß İ Σίγμας", "1234 5,6.7", "🙂🙂 🙂", "A" * 5000]
