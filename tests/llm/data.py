"""Small hostile tables and plain restatements of the operators' contracts."""

from __future__ import annotations

import random
import re

from pyspark.sql import types as T

SPACE = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                     # names that the operators use inside
                     *(T.StructField(n, T.StringType()) for n in ("id", "size", "key", "bucket", "lane", "name", "hull", "runs", "spans", "component",
                                                                  "statistics", "digest", "symbols", "shard", "row", "members"))])


def sentence(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def hostile(seed: int = 3) -> list[tuple]:
    """Nulls, empties, blanks, copies, near copies, shared passages, periodic and long texts, odd characters."""
    rng = random.Random(seed)
    base, passage = sentence(rng, 120), sentence(rng, 60)
    texts = [None, "", " \t\n\x0b\x0c\r ", "a", "A", "été Été", "日本語 テキスト 日本語", "\x00 nul \x7f", "x" * 1500, "ab " * 400, "á ë z", base, base, base.upper(),
             base + " ", base.replace(" ", "\n"), passage + " " + sentence(rng, 50), sentence(rng, 50) + " " + passage, "don't we'll 's ...'s ###abc,x 12,3  b",
             "<|endoftext|> <|ENDOFTEXT|> tail", sentence(rng, 3), sentence(rng, 4), sentence(rng, 5000, 3000), "İstanbul ǅ ß ΑΣ"]
    for _ in range(12):
        words = base.split()
        for _ in range(rng.randrange(1, 7)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(1000)}"
        texts.append(" ".join(words))
    texts += [sentence(rng, rng.randrange(1, 200)) for _ in range(20)]
    rows = []
    for i, text in enumerate(texts):
        lang = rng.choice(["en", "de", None])
        rows.append((i * 7 % 97, text, lang, rng.choice([None, "s1", "s2", "é", "s0", "s0", "s0"]), len(text or ""), *["clash"] * 16))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")
