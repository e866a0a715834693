"""Plain-Python statements of the contracts, for comparison."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(*r, "en", "a")[:2] + (r[2:] if len(r) == 4 else ("en", "a")) + (len(r[1] or ""),) for r in rows]
    return spark.createDataFrame(full, DOC)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]
