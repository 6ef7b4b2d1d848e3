"""Small inputs and readings of the same rules by other means."""

import os
import re

SF = os.environ.get("TEST_LLM_SF_DIR", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")

ODD = [None, "", " \n\t", "a", "a b c", "x " * 30_000, "Ünï çödé 𝔘𝔫𝔦 <|im_end|> \\ | $$ \x00 é́", "same text here", "same text here", "a\n\nb\nb\n"]


def documents(spark, texts, extra=True):
    """doc_id, text and columns whose names operators use themselves."""
    rows = [(i, t, "en", None, i, i, "x") for i, t in enumerate(texts)]
    names = "doc_id long, text string, lang string, source string, n_chars long, id long, spans string"
    df = spark.createDataFrame(rows, names)
    return df if extra else df.select("doc_id", "text")


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
