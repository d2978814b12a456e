"""Small tables with every odd case: nulls in any column, empty and very long
texts, ties, repeated rows, and extra columns whose names clash."""

from __future__ import annotations

import random
import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASH = ["shard", "slot", "size", "band", "key", "root", "cid", "n", "uid", "held_out", "part", "seq", "block", "raw", "k", "m",
         "hub", "start", "words", "count", "reg", "a", "b"]
LONG = "Lorem ipsum " * 200_000       # 2.4 MB: a slice of its own


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def alnum(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def texts() -> list[tuple[int | None, str | None]]:
    r = random.Random(5)
    vocabulary = "the of And über naïve 中文 x1 2024 it's <|endoftext|> end. a,b don't\ttab  \n\n\x1f \u00a0 \u3000 é".split(" ")
    rows = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 60)))) for i in range(40)]
    rows += [(40, None), (41, ""), (42, "   \n\t "), (43, LONG), (44, rows[3][1]), (45, rows[3][1]), (None, rows[5][1]), (None, None),
             (46, "one"), (47, "One"), (48, "a" * 5000), (49, "ab" * 3000), (50, "  lead"), (51, "trail  ")]
    return rows + [rows[7], rows[7]]           # whole rows that repeat


def documents(spark, rows=None, clash: bool = True):
    rows = texts() if rows is None else rows
    data = [(i, t, None if k % 5 == 0 else ["en", "fr"][k % 2], None if k % 7 == 0 else f"src{k % 3}", None if k % 4 == 0 else len(t or ""),
             *([k] * len(CLASH) if clash else [])) for k, (i, t) in enumerate(rows)]
    schema = "doc_id long, text string, lang string, source string, n_chars long" + (", " + ", ".join(f"{c} long" for c in CLASH) if clash else "")
    return spark.createDataFrame(data, schema)


def empty(spark, clash: bool = True):
    return documents(spark, [], clash)
