"""Small tables with the cases every operator must bear, and plain helpers for brute force."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tag string, label string, n long, _doc_id long"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, width=5):
    own = words(lowered(text))
    if not own:
        return frozenset()
    return frozenset(tuple(own[i : i + width]) for i in range(max(1, len(own) - width + 1)))


def prose(rng, count, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" + rng.choice(["", "", "", ",", "."]) for _ in range(count))


def documents(spark, texts, first=0, lang="en"):
    """Texts as a documents table; a pair (id, text) sets its own id. Extra columns have names that operators use."""
    rows = []
    for place, text in enumerate(texts):
        doc_id, text = text if isinstance(text, tuple) else (first + place, text)
        rows.append((doc_id, text, lang, "src0", len(text or ""), "x", "y", 1, 7))
    return spark.createDataFrame(rows, SCHEMA)


def awkward(rng):
    """Nulls, empties, white space, short and very long texts, repeated rows and ids, non-ASCII, a row without an id."""
    long_text = "\n".join(prose(rng, 40) for _ in range(300))
    return [
        (900, None), (901, ""), (902, " \t\n\r "), (903, "one two"), (904, "one two"), (905, "one  Two"),
        (906, long_text), (907, long_text), (908, long_text + " more of it"), (909, "aaaa " * 400), (910, "a" * 3000),
        (911, "é" * 900 + " ünï"), (912, "\n\n\n"), (913, "same row again and again here"), (913, "same row again and again here"),
        (914, prose(rng, 60)), (914, prose(rng, 60)), (None, prose(rng, 60)), (None, "same row again and again here"),
    ]
