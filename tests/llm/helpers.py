"""Small tables with the awkward cases, and plain Python versions of the operators."""

import hashlib
import random
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("row", "kept", "label", "size", "lines", "gone", "at", "sha", "n_words", "block", "key", "part",
           "__row", "__place", "rank", "end", "a.b", "kept.text", "q")


def frame(spark, texts, ids=None, sources=None, parts=3):
    """documents of the given texts, with further columns whose names the operators use inside."""
    ids = list(range(len(texts))) if ids is None else ids
    sources = ["s"] * len(texts) if sources is None else sources
    rows = [(i, t, "en", s, None if t is None else len(t), *["x"] * len(CLASHES))
            for i, t, s in zip(ids, texts, sources, strict=True)]
    df = spark.createDataFrame(rows, SCHEMA + "".join(f", `{c}` string" for c in CLASHES))  # names with dots too
    return df.repartition(parts, "doc_id", "text") if parts > 1 else df.coalesce(1)


def stored(df, spark, tmp_path, name="docs"):
    df.write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / name))


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def prose(seed, n, vocabulary=4000):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


AWKWARD = [None, "", " ", "\n\n", "a", "A", "word", "\t \r\n", "é è", "one two three four", "x " * 30, "z\n" * 50,
           prose(1, 20000), "same text here", "same text here", "SAME text here", "\x85\xa0   字 🙂", "<p>&amp;"]


def repeats(texts, k):
    """Marks of the words of each text under windows of k words that start elsewhere too."""
    split = [words(t) for t in texts]
    count = Counter(tuple(w[i:i + k]) for w in split for i in range(len(w) - k + 1))
    out = []
    for w in split:
        marks = [False] * len(w)
        for i in range(len(w) - k + 1):
            if count[tuple(w[i:i + k])] > 1:
                marks[i:i + k] = [True] * k
        out.append(marks)
    return split, out
