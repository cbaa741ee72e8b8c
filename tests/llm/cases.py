"""Small document tables with the awkward cases: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, slot int, shard string, kept boolean, rid string, score string, n_words string"


def documents(seed: int = 1, n: int = 120) -> list[tuple]:
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghiklmnorstuvé") for _ in range(r.randint(2, 9))) for _ in range(400)]
    passage = " ".join(r.choice(words) for _ in range(90))
    texts = [" ".join(r.choice(words) for _ in range(r.randint(1, 250))) for _ in range(n)]
    base = texts[0] = " ".join(r.choice(words) for _ in range(120))
    for k in range(5, 20):  # near copies of one text, some of them beyond the threshold from each other
        w = base.split(" ")
        for _ in range(r.randint(0, 5)):
            w[r.randrange(len(w))] = r.choice(words)
        texts[k] = " ".join(w)
    for k in range(20, 26):
        texts[k] = f"{texts[k]} {passage} {texts[k - 10][:200]}"
    texts[30:33] = [texts[29]] * 3
    texts[33] = (texts[34] + "\n") * 8
    texts[35], texts[36], texts[37] = "One", "two words", "Three small words"
    texts[38] = " ".join(r.choice(words) for _ in range(12000))
    texts[39] = "ab" * 900
    texts[40], texts[41] = "", " \t\n"
    texts[42] = None
    texts[43] = "!!! 123 ###"
    texts[44] = "it's <|endoftext|> “quoted” ½ İstanbul\x0bx y 日本語"
    texts[45] = base.upper()
    rows = [(i, t, r.choice(["en", "fr", None]), f"src{i % 3}", None if t is None else len(t), 7, "s", None, "r", "x", "y") for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[4], "en", None, 1, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None, None), (50, texts[51], "en", "z", 2, 1, "q", True, "r", "x", "y")]
    return rows


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA)


def items(rows: list[tuple]) -> list[tuple]:
    """Benchmark items: a passage of a document, overlapping ones, short ones, one word, none."""
    t = rows[60][1].split(" ") if len(rows[60][1].split(" ")) > 40 else rows[38][1].split(" ")
    return [(1, " ".join(t[5:30]).upper()), (2, " ".join(t[12:24])), (10, " ".join(t[:7])), (3, rows[43][1]), (4, ""), (5, None), (None, "Three small, words"), (7, "no such words at all in any of the documents zzzz qqqq here")]
