"""Rows that any operator on documents must take."""

import random
import re

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return SPACE.findall(lower(text))


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def corpus(seed=1):
    """Texts with exact and near copies, shared passages, null and empty ones, repeated rows, a long one, odd spaces."""
    rng = random.Random(seed)
    passage = prose(rng, 70)
    base = prose(rng, 120)
    rows = [base, base, base.upper(), None, "", " \t ", "one two", "one  two", "ONE\ttwo", "a b c d e", passage]
    for _ in range(6):  # altered copies
        w = base.split()
        for i in rng.sample(range(len(w)), 2):
            w[i] = f"x{rng.randrange(10**6)}"
        rows.append(" ".join(w))
    for _ in range(5):
        rows.append(prose(rng, 40) + "\n" + passage + " end " + prose(rng, 30))
    rows += [prose(rng, rng.randrange(3, 150)) for _ in range(20)]
    rows.append(prose(rng, 6000, 10**6))
    return [(i, t, "en" if i % 3 else "de", f"s{i % 3}" if i % 5 else None, len(t) if t else 0) for i, t in enumerate(rows)]


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema).repartition(3)
