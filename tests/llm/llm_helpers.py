import random

WORDS = "alpha beta gamma delta omega river stone cloud maple ember quartz signal harbor lantern meadow".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(60)) for _ in range(n))


def documents(spark, rows):
    """(doc_id, text[, source]) rows as documents, with columns that clash with results."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s0", len(r[1] or ""), 9, "x") for r in rows]
    return spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint, "
                                       "score int, spans string")


EDGE = [(1, None), (2, ""), (3, "   \n\n "), (4, "one"), (5, prose(5, 40)), (5, prose(5, 40)), (None, prose(6, 30)),
        (7, prose(7, 20_000)), (8, "▁ \u0000 日本語 😀\t\r\n  é")]
